"""Column expressions that read and compare final answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleflow.functions.text import clean_text, let

BOX = "\\boxed{"

# Possessive throughout: the matcher loops instead of recursing, so a box of any
# length is read without deep stacks, and nothing it gives up could close the box.
_TO_CLOSING_BRACE = r"^(?:[^{}]++|\{[^{}]*+\})*+\}"


def boxed_answer(text: Column | str) -> Column:
    """Content of the last ``\\boxed{...}`` with at most one level of inner braces.

    Null when there is no box or the last one does not close.
    """
    text = F.col(text) if isinstance(text, str) else text
    closed = F.regexp_substr(F.substring_index(text, BOX, -1), F.lit(_TO_CLOSING_BRACE))
    return F.when(F.contains(text, F.lit(BOX)), F.regexp_replace(closed, r"\}\z", ""))


# How numbers are spelled.
_PLAIN = r"^[+-]?(?:\d+\.?\d*|\.\d+)$"
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_GROUPED = r"^[+-]?[1-9]\d{0,2}(?:,\d{3})+(?:\.\d*)?$"


def normal_answer(answer: Column) -> Column:
    """An answer without dollar signs and surplus white space."""
    return clean_text(F.replace(answer, F.lit("$"), F.lit("")))


def _finite(text: Column) -> Column:
    """Digits as a finite double; words a cast would also take (NaN, 1d) are not numbers here."""
    value = F.when(F.rlike(text, F.lit(_NUMBER)), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def _exact(text: Column) -> Column:
    """The one spelling of a plain number: no sign of plus, no outer zeros."""
    whole = F.regexp_extract(text, r"^[+-]?0*(\d*)", 1)
    rest = F.regexp_extract(text, r"\.(\d*?)0*$", 1)
    number = F.concat(F.when(whole == "", F.lit("0")).otherwise(whole), F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)))
    signed = F.when(text.startswith("-") & (number != "0"), F.concat(F.lit("-"), number)).otherwise(number)
    return F.when(F.rlike(text, F.lit(_PLAIN)), signed)


#: Digits in a limb of a long product.
_LIMB = 6


def _times(a: Column, b: Column) -> Column:
    """The product of two digit texts, of any length; its work grows with the product of their lengths."""

    def limbs(text: Column) -> Column:
        n = F.ceil(F.length(text) / _LIMB).cast("int")
        padded = F.lpad(text, n * _LIMB, "0")
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(padded, (n - i) * _LIMB + 1, F.lit(_LIMB)).cast("long"))

    def summed(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        n, m = F.size(x), F.size(y)

        def place(k: Column) -> Column:
            ways = F.sequence(F.greatest(F.lit(0), k - m + 1), F.least(k, n - 1))
            return F.aggregate(ways, F.lit(0).cast("long"), lambda sum_, i: sum_ + F.get(x, i) * F.get(y, k - i))

        places = F.transform(F.sequence(F.lit(0), n + m - 2), place)
        start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("over"))

        def carried(done: Column, value: Column) -> Column:
            total = done["over"] + value
            digits = F.lpad((total % 10**_LIMB).cast("string"), _LIMB, "0")
            return F.struct(
                F.concat(digits, done["text"]).alias("text"), F.call_function("div", total, F.lit(10**_LIMB)).alias("over")
            )

        whole = F.aggregate(places, start, carried, lambda done: F.concat(done["over"].cast("string"), done["text"]))
        return F.regexp_replace(whole, r"^0+(?=\d)", "")

    short = (a.cast("long") * b.cast("long")).cast("string")
    long = let(F.struct(limbs(a).alias("x"), limbs(b).alias("y")), summed)
    return F.when(F.length(a) + F.length(b) <= 18, short).otherwise(long)


# How fractions are spelled, with at most one fraction inside each part.
_INNER = r"^([+-]?)\\[dt]?frac\{([^{}]+)\}\{([^{}]+)\}$"
_OUTER = r"^([+-]?)\\[dt]?frac\{((?:[^{}]|\{[^{}]*\})+)\}\{((?:[^{}]|\{[^{}]*\})+)\}$"


def _spelled(text: Column) -> Column:
    """``a/b`` for a fraction without fractions inside, with the sign before ``a``; other texts as they are."""
    return F.regexp_replace(text, _INNER, "$1$2/$3")


def _numbers(text: Column) -> Column:
    """The four numbers of ``(a/b)/(c/d)`` with what is not there as 1, and a sign; not all plain if the text is no fraction."""
    outer = F.rlike(text, F.lit(_OUTER)) & ~F.rlike(text, F.lit(_INNER))
    top = _spelled(F.when(outer, F.regexp_extract(text, _OUTER, 2)).otherwise(text))
    bottom = _spelled(F.when(outer, F.regexp_extract(text, _OUTER, 3)).otherwise(F.lit("1")))

    def halves(part: Column) -> Column:
        return F.when(F.contains(part, F.lit("/")), F.split(part, "/", -1)).otherwise(F.array(part, F.lit("1")))

    sign = F.when(outer & text.startswith("-"), F.lit("-1")).otherwise(F.lit("1"))
    return F.concat(halves(top), halves(bottom), F.array(sign))


def _ratio(n: Column) -> Column:
    """Struct ``minus``, ``top``, ``bottom`` (lists of digits to multiply) of four numbers and a sign; null if one is not plain or divides as 0."""
    a, b, c, d = (F.get(n, F.lit(i)) for i in range(4))

    def digits(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, r"[+.-]", ""), r"^0+(?=\d)", "")

    def shifted(text: Column, *others: Column) -> Column:
        """Zeros for the places that the other side of the fraction has after its points."""
        places = sum((F.length(F.regexp_extract(o, r"\.(\d*)$", 1)) for o in others[1:]), F.length(F.regexp_extract(others[0], r"\.(\d*)$", 1)))
        number = digits(text)
        return F.when(number == "0", number).otherwise(F.concat(number, F.repeat(F.lit("0"), places)))

    zero = digits(a) == "0"
    minus = (F.size(F.filter(n, lambda x: x.startswith("-"))) % 2 == 1) & ~zero
    plain = (F.size(n) == 5) & F.forall(n, lambda x: F.rlike(x, F.lit(_PLAIN)))
    defined = (digits(b) != "0") & (digits(c) != "0") & (digits(d) != "0")
    top, bottom = F.array(shifted(a, b, c), digits(d)), F.array(shifted(b, a, d), digits(c))
    ratio = F.struct(minus.alias("minus"), top.alias("top"), bottom.alias("bottom"))
    return F.when(plain & defined, ratio)


def answer_number(normal: Column) -> Column:
    """The number a normalised answer spells: plain, with thousands commas, or a fraction.

    ``exact`` is the spelling of a plain number without what does not count, however
    long; ``ratio`` a plain number or fraction (``a/b``, ``\\frac{a}{b}``, with fractions of
    plain numbers inside) as sign and factors of its two parts, not reduced; ``near`` is the
    closest double, null if it would not be finite.
    """

    def valued(at: Column) -> Column:
        numbers = F.slice(at["numbers"], 1, 4)
        x = [_finite(F.get(numbers, F.lit(i))) for i in range(4)]
        over = F.try_divide(F.try_divide(x[0], x[1]), F.try_divide(x[2], x[3])) * F.get(at["numbers"], F.lit(4)).cast("double")
        over = F.when((F.size(at["numbers"]) == 5) & (F.abs(over) < float("inf")), over)
        near = F.coalesce(_finite(at["digits"]), over)
        return F.struct(_exact(at["digits"]).alias("exact"), _ratio(at["numbers"]).alias("ratio"), near.alias("near"))

    grouped = F.when(F.rlike(normal, F.lit(_GROUPED)), F.replace(normal, F.lit(","), F.lit(""))).otherwise(normal)
    read = let(grouped, lambda t: F.struct(t.alias("digits"), _numbers(t).alias("numbers")))
    return let(read, valued)


def same_answer(text: Column, number: Column, gold_text: Column, gold_number: Column) -> Column:
    """Whether two normalised answers, with the numbers they spell, say the same.

    Plain numbers are compared digit by digit, fractions by their cross products, both exactly;
    doubles decide only where a power of ten is spelled with an exponent.
    """

    def both(name: str) -> Column:
        return number[name].isNotNull() & gold_number[name].isNotNull()

    a, b = number["ratio"], gold_number["ratio"]
    sides = F.array(F.concat(a["top"], b["bottom"]), F.concat(b["top"], a["bottom"]))
    products = F.transform(sides, lambda factors: F.aggregate(factors, F.lit("1"), _times))
    crossed = (a["minus"] == b["minus"]) & (F.size(F.array_distinct(products)) == 1)
    same = (
        F.when(both("exact"), number["exact"] == gold_number["exact"])
        .when(both("ratio"), crossed)
        .otherwise(number["near"] == gold_number["near"])
    )
    return F.coalesce(text == gold_text, F.lit(False)) | F.coalesce(same, F.lit(False))


def answer_match(answer: Column | str, gold: Column | str) -> Column:
    """Whether an answer says the same as the gold answer; a missing one never does."""

    def forms(value: Column | str) -> Column:
        text = normal_answer(F.col(value) if isinstance(value, str) else value)
        return let(text, lambda t: F.struct(t.alias("text"), answer_number(t).alias("number")))

    def same(pair: Column) -> Column:
        a, g = pair["a"], pair["g"]
        return same_answer(a["text"], a["number"], g["text"], g["number"])

    return let(F.struct(forms(answer).alias("a"), forms(gold).alias("g")), same)
