"""Small tables for the tests of this folder."""

import random
import re

from sampleflow.llm.exact import LOWER, UPPER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE_KIND = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, key string, row string, "
    "node binary, n long, hash string, kept boolean, cell string, template string"
)


def lower(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def words(text):
    return WORD.findall(text or "")


def texts(seed=3, n=60):
    """Made-up texts with exact, near and partial copies."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdeéß", k=pick.randint(1, 7))) for _ in range(400)]
    out = [" ".join(pick.choices(vocabulary, k=pick.randint(1, 160))) for _ in range(n)]
    passage = " ".join(pick.choices(vocabulary, k=45))
    for i in range(n // 2):
        base = out[pick.randrange(n)].split(" ")
        kind = i % 5
        if kind == 0:
            out.append(" ".join(base).upper() if i % 2 else " ".join(base))
        elif kind in (1, 2):
            for _ in range(max(1, len(base) // 60)):
                base[pick.randrange(len(base))] = pick.choice(vocabulary)
            out.append("  ".join(base) + "\n")
        elif kind == 3:
            at = pick.randrange(len(base) + 1)
            out.append(" ".join(base[:at]) + f" {passage} " + " ".join(base[at:]))
        else:
            out.append("\n".join(base[: len(base) // 2] * 2))
    return out


def edge_rows():
    """Nulls, empty and long texts, repeated rows, repeated and null ids, clashing column names."""
    long = " ".join(f"w{i % 997} x{i}" for i in range(20_000))
    rows = list(enumerate(texts()))
    top = len(rows)
    rows += [(top, None), (top + 1, ""), (top + 2, " \n\t "), (top + 3, None), (top + 4, long), (top + 5, long + " end")]
    rows += [(top + 6, "one"), (top + 7, "ONE"), (top + 8, "one two"), (top + 9, "42 !!"), (top + 10, "a " * 3000)]
    rows += [rows[5], rows[5], rows[top], (7, "another text with a used id, long enough to count as one")]
    rows += [(None, rows[9][1]), (None, "no id here"), (None, None)]
    langs, sources = ["en", "fr", None], ["s1", "s2", "é", None]
    return [
        (i, t, langs[k % 3], sources[k % 4], 0, k, "key", "row", b"x", 1, "h", True, "c", "t") for k, (i, t) in enumerate(rows)
    ]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGE_KIND).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], EDGE_KIND)
