"""Collocations against counting all n-grams one by one."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import sampleflow.llm.phrases as phrases
from sampleflow.llm.phrases import Summary, collocations
from tests.llm.cases import edge_docs, edge_rows, lower, no_docs


def plain(rows, least, longest, top, inside):
    said, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            said[lang] += len(words)
            for n in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    out = []
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    for (lang, phrase), a in candidates.items():
        cuts = [
            (1_000_000 * a * a // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k, f[lang, phrase[:k]], f[lang, phrase[k:]])
            for k in range(1, len(phrase))
        ]
        score, _, left, right = min(cuts)
        held = any(
            len(q) > len(phrase) and other == lang and 100 * b >= inside * a
            and any(q[i : i + len(phrase)] == phrase for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if not held:
            out.append((lang, -score, -a, " ".join(phrase).encode(), left, right))
    found = []
    for lang in {o[0] for o in out}:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(o for o in out if o[0] == lang)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, said[lang], -score))
    return sorted(found)


def made_up(n=150):
    pick = random.Random(5)
    vocabulary = ["a", "b", "é", "New", "new", "york", "city", "ß", "x1", "日本"]
    breaks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\x0c", "\r", "\xa0", ""]
    rows = [(pick.choice(["en", "fr", None, "und"]), "".join(pick.choice(vocabulary) + pick.choice(breaks) for _ in range(pick.randint(0, 80)))) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("de", "new york"), ("en", " . , \n"), ("fr", "new york city " * 3000)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_plain(spark):
    rows = made_up()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for options in ((10, 3, 2000, 50), (3, 4, 7, 90), (2, 2, 5, 0)):
        assert got(collocations(df, *options)) == plain(rows, *options)
    assert collocations(df).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_small_summaries(spark, monkeypatch):
    """Summaries that must drop counters, and a filter that most n-grams pass, change nothing."""
    rows = [(lang, " ".join(random.Random(i).choices("abcdefghij", k=60))) for i, lang in enumerate(["en", "fr"] * 60)]
    rows += [("en", " ".join(f"w{i}x{k}" for k in range(200))) for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = plain(rows, 10, 3, 50, 50)
    monkeypatch.setattr(phrases, "HELD_GRAMS", 500)
    monkeypatch.setattr(phrases, "COUNTERS", 1)
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 12)
    assert got(collocations(df, 10, 3, 50)) == want


def test_words_of_one_hash(spark):
    """Words that polynomials modulo 2^64 cannot tell apart (Thue and Morse) are different words."""
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    rows = [("en", f"{one} c {two} c {two} d, {one} e {two} e")] * 12
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(collocations(df)) == plain(rows, 10, 3, 2000, 50)


def test_edges(spark):
    rows = [(r[2], r[1]) for r in edge_rows()]
    assert got(collocations(edge_docs(spark), 3, 3, 40)) == plain(rows, 3, 3, 40, 50)
    assert collocations(no_docs(spark)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=30), max_size=8), st.integers(1, 6))
def test_guarantee(parts, least):
    """Merged in any cut, every key found ``least`` times survives."""
    every = Counter(k for p in parts for k in p)
    summary = Summary(sum(map(len, parts)) // least + 1)
    for part in parts:
        here = Counter(part)
        summary.add(np.array(sorted(here), np.uint64), np.array([here[k] for k in sorted(here)], np.int64))
        summary.merge()
    left = set(summary.survivors(least).tolist())
    assert summary.missed < least
    assert {k for k, n in every.items() if n >= least} <= left
