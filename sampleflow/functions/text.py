"""Column expressions on text: cleaning, cutting, hashing, JSON, durations."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space as Python's str.split sees it: Java's class lacks four separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def input_text(column: Column | str) -> Column:
    """Any value as prompt text; a missing value reads ``None``."""
    return F.coalesce(_col(column).cast("string"), F.lit("None"))


def clean_text(text: Column | str) -> Column:
    """Turn each run of white space into one blank and trim the ends."""
    return F.trim(F.regexp_replace(_col(text), WHITESPACE, " "))


def _head(text: Column, n: int) -> Column:
    """First ``n`` characters; a negative ``n`` leaves that many off the end."""
    if n >= 0:
        return F.substring(text, 1, n)
    return F.substring(text, F.lit(1), F.greatest(F.length(text) + n, F.lit(0)))


def truncate_hard(text: Column | str, max_length: int | None) -> Column:
    """Cut longer texts to ``max_length`` characters; ``None`` and 0 mean no limit."""
    text = _col(text)
    return _head(text, max_length) if max_length else text


def truncate_suffix(text: Column | str, max_length: int = 100, suffix: str = "...") -> Column:
    """Cut longer texts so that they fit ``max_length`` with ``suffix`` at the end."""
    text = _col(text)
    cut = F.concat(_head(text, max_length - len(suffix)), F.lit(suffix))
    return F.when(F.length(text) <= max_length, text).otherwise(cut)


def preview_text(text: Column | str, n: int = 100) -> Column:
    """The first ``n`` characters followed by three dots, whatever the length."""
    return F.concat(F.substring(_col(text), 1, n), F.lit("..."))


def batch_hash(text: Column | str) -> Column:
    """First eight hex digits of the md5 of a text."""
    return F.substring(F.md5(_col(text)), 1, 8)


@F.pandas_udf(T.StringType())
def _sorted_json(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: json.dumps(json.loads(t), sort_keys=True), na_action="ignore")


def _json_text(text: Column) -> Column:
    """A text as an ASCII JSON string: short escapes where JSON has them, else ``\\uXXXX``, in pairs beyond the basic plane."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def escaped(char: Column) -> Column:
        code, above = F.ascii(char), F.ascii(char) - 0x10000
        pair = F.concat(unit(F.shiftright(above, 10) + 0xD800), unit(above.bitwiseAND(0x3FF) + 0xDC00))
        found = F.when((code >= 0x20) & (code <= 0x7E), char)
        for short, char_of in (("\\b", "\b"), ("\\t", "\t"), ("\\n", "\n"), ("\\f", "\f"), ("\\r", "\r")):
            found = found.when(char == char_of, F.lit(short))
        return found.when(code <= 0xFFFF, unit(code)).otherwise(pair)

    quoted = F.regexp_replace(text, r'(["\\])', r"\\$1")
    other = F.array_join(F.transform(F.filter(F.split(quoted, ""), lambda c: c != ""), escaped), "")
    return F.concat(F.lit('"'), F.when(F.rlike(text, F.lit(r"[^\x20-\x7e]")), other).otherwise(quoted), F.lit('"'))


def _shortest(value: Column) -> Column:
    """Struct ``digits``, ``point`` of a finite double: 0.digits times ten to the point, in as few digits as read back alike.

    Java's own spelling can be too long where it has 16 digits or more; it is rounded to 15,
    16 and 17 digits, and the first that reads back is taken.
    """
    size = F.abs(value)
    # Whole numbers of this size are spelled exactly, so that rounding meets the nearest. Above it Java 17 can
    # miss the nearest 17 digits (4 of 700,000 doubles tried).
    java = F.when((size >= 2.0**53) & (size < 9.22e18), F.concat(size.cast("long").cast("string"), F.lit(".0"))).otherwise(size.cast("string"))
    java = F.when(size == 5e-324, F.lit("5.0E-324")).otherwise(java)

    def read(t: Column) -> Column:
        power = F.coalesce(F.nullif(F.regexp_extract(t, r"E(-?\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
        part = F.regexp_extract(t, r"\.(\d*?)0*(?:E|$)", 1)
        both = F.regexp_replace(F.concat(F.regexp_extract(t, r"^(\d+)", 1), part), r"^0+(?=\d)", "")
        return F.struct(both.alias("whole"), (power - F.length(part)).alias("ten"))

    def cut(n: int, at: Column) -> Column:
        drop = F.length(at["whole"]) - n
        unit = F.rpad(F.lit("1"), drop + 1, "0").cast("long")
        number = F.call_function("div", at["whole"].cast("long") + F.call_function("div", unit, F.lit(2)), unit).cast("string")
        same = F.concat(number, F.lit("E"), (at["ten"] + drop).cast("string")).cast("double") == size
        return F.when((drop > 0) & same, F.struct(number.alias("whole"), (at["ten"] + drop).alias("ten")))

    def ends(at: Column) -> Column:
        digits = F.regexp_replace(at["whole"], "0+$", "")
        return F.struct(digits.alias("digits"), (F.length(at["whole"]) + at["ten"]).alias("point"))

    return let(let(let(java, read), lambda at: F.coalesce(*(cut(n, at) for n in (15, 16, 17)), at)), ends)


def _json_double(value: Column) -> Column:
    """A double in its shortest digits: plain from 1e-4 to below 1e16, else with an exponent of two digits or more."""

    def spelled(at: Column) -> Column:
        digits, point, size = at["digits"], at["point"], F.length(at["digits"])
        fixed = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size), F.lit(".0")))
            .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size)))
        )
        tail = F.when(size > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), size))).otherwise(F.lit(""))
        power = F.abs(point - 1).cast("string")
        power = F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power)
        raised = F.concat(F.substring(digits, 1, 1), tail, F.when(point < 1, F.lit("e-")).otherwise(F.lit("e+")), power)
        return F.when(digits == "", F.lit("0.0")).when((point > -4) & (point <= 16), fixed).otherwise(raised)

    sign = F.when(value.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    named = F.isnan(value) | (F.abs(value) == float("inf"))
    text = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    return F.when(named, text).otherwise(F.concat(sign, let(_shortest(value), spelled)))


def sorted_json(value: Column | str, kind: T.DataType) -> Column:
    """A value of type ``kind`` as ASCII JSON text with sorted keys and a blank after commas and colons.

    Built from column expressions by a walk over the type.  Null is ``null``; NaN and the
    infinities are texts; beyond 9e18 a double of 17 digits can end in another digit than the nearest
    (4 of 700,000 tried), which reads back alike; decimals with a scale are spelled as the nearest double; dates, times
    and binaries are the texts that Spark's JSON writes.  Fields of one name are refused.
    """
    value = _col(value)
    if isinstance(kind, T.StructType):
        names = sorted(kind.names)
        if len(set(names)) < len(names):
            raise ValueError(f"fields of one name: {names}")
        fields = [F.concat(F.lit(json.dumps(n) + ": "), sorted_json(value.getField(n), kind[n].dataType)) for n in names]
        text = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}")))
    elif isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda v: sorted_json(v, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].cast("string").alias("k"), e["value"].alias("v")))
        order = lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)
        item = lambda e: F.concat(_json_text(e["k"]), F.lit(": "), sorted_json(e["v"], kind.valueType))
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(entries, order), item), ", "), F.lit("}"))
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        text = _json_text(value)
    elif isinstance(kind, T.FloatType):
        text = _json_double(value.cast("string").cast("double"))
    elif isinstance(kind, T.DoubleType):
        text = _json_double(value)
    elif isinstance(kind, T.DecimalType) and kind.scale > 0:
        text = _json_double(value.cast("double"))
    elif isinstance(kind, (T.BooleanType, T.IntegralType, T.DecimalType)):
        text = value.cast("string")
    elif isinstance(kind, T.NullType):
        return F.lit("null")
    elif isinstance(kind, (T.VariantType, T.UserDefinedType)):
        raise TypeError(f"no sorted JSON for {kind.simpleString()}")
    else:
        text = _json_text(F.get_json_object(F.to_json(F.struct(value.alias("v"))), "$.v"))
    return F.coalesce(text, F.lit("null"))


def batch_hash_struct(record: Column | str, kind: T.DataType | str | None = None) -> Column:
    """``batch_hash`` of a struct or map, as JSON with sorted keys; null for null.

    With its type (or DDL) the JSON is built by Spark (``sorted_json``).  A column does not
    know its type before it is used, so without one the keys are sorted in Arrow batches.
    """
    record = _col(record)
    if kind is None:
        return batch_hash(_sorted_json(F.to_json(record, {"ignoreNullFields": "false"})))
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    return F.when(record.isNotNull(), batch_hash(sorted_json(record, kind)))


def _in_json(text: Column, path: str, kind: str) -> Column:
    """What ``path`` names in a text that is one JSON value; null where the text is not one or has no such thing.

    The parser ignores what follows a complete value, so the text is read as a list's only
    item.  A text without ``]`` cannot end that list early; one with it must parse inside an
    object too, and no text but a single value parses inside both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    more = F.try_variant_get(listed, "$[1]", "variant")
    single = listed.isNotNull() & F.when(F.contains(text, F.lit("]")), named.isNotNull()).otherwise(more.isNull())
    return F.when(single, F.try_variant_get(listed, "$[0]" + path.removeprefix("$"), kind))


def json_or_default(text: Column | str, default: str = "null") -> Column:
    """Parsed JSON as a variant; ``default`` (JSON text) where the text does not parse."""
    return F.coalesce(_in_json(_col(text), "$", "variant"), F.parse_json(F.lit(default)))


def json_field_or_default(text: Column | str, path: str, kind: str, default: object) -> Column:
    """One field of a JSON text, or ``default`` if the text or the field is unusable."""
    return F.coalesce(_in_json(_col(text), path, kind), F.lit(default).cast(kind))


def one_decimal(value: Column) -> Column:
    """A double rounded to one decimal by its exact binary value, ties to even.

    Spark's own formatter rounds the shortest decimal spelling instead: it prints
    0.3 for 0.25 and 16.7 for 16.65.  The remainder of ``value * 10`` that the
    product loses is recovered by splitting the factor in two exact halves.
    """
    size = F.abs(value)
    scaled = size * 10.0
    high = size * 134217729.0 - (size * 134217729.0 - size)
    lost = (high * 10.0 - scaled) + (size - high) * 10.0
    whole = F.floor(scaled)
    part = scaled - whole
    up = (
        (part > 0.5)
        | ((part == 0.5) & (lost > 0))
        | ((part == 0.5) & (lost == 0) & (whole % 2 == 1))
    )
    tenths = whole + up.cast("long")
    sign = F.when((value < 0), F.lit("-")).otherwise(F.lit(""))
    units, tenth = F.floor(tenths / 10).cast("string"), (tenths % 10).cast("string")
    return F.concat(sign, units, F.lit("."), tenth)


def format_duration(seconds: Column | str) -> Column:
    """Seconds as ``12.3s``, ``4.5m`` or ``6.7h``."""
    seconds = _col(seconds).cast("double")
    size = F.when(seconds < 60, 1.0).when(seconds < 3600, 60.0).otherwise(3600.0)
    unit = F.when(seconds < 60, "s").when(seconds < 3600, "m").otherwise("h")
    return F.concat(one_decimal(seconds / size), unit)
