"""Quality rules: counted base rules, then a calibrated logistic regression on hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleflow.llm.words import IS_WORD, Words, pieces, sort_by_row, span_hashes, window_hashes

U = np.uint64
#: Weights of each family: words, pairs of words, four bytes.
FAMILY_BITS = 16
FAMILIES = 3
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
#: Base rules and the least calibrated probability of good quality.
LEAST_WORDS, MOST_REPEATED_PERCENT, LEAST_QUALITY = 50, 50, 0.5


def _by_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[ends])


def base_counts(words: Words) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` of each text."""
    data, rows = words.data, len(words.counts)
    inside = IS_WORD[data]
    out = {
        "n_words": words.counts,
        "word_chars": _by_row(inside & ((data & 0xC0) != 0x80), words.offsets),
        "n_symbols": _by_row(SYMBOL[data], words.offsets),
    }
    # Lines: cut at line feeds and at the ends of texts; only those with a word count.
    full = words.offsets[:-1] < words.offsets[1:]
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.union1d(feeds + 1, words.offsets[:-1][full])
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 0x0A)) if len(starts) else ends
    seen = np.concatenate(([0], np.cumsum(inside)))
    with_word = seen[ends] > seen[starts]
    starts, ends = starts[with_word], ends[with_word]
    line = span_hashes(data.astype(U) + U(1), starts, ends)
    row = np.searchsorted(words.offsets, starts, "right") - 1
    out["n_dup_lines"] = np.bincount(row, minlength=rows)[:rows] - _distinct(row, line, rows)
    # Words in windows of three that the text has twice or more.
    at = words.window_starts(3)
    window, row = window_hashes(words.hashes(), 3)[at], words.doc[at]
    order = sort_by_row(row, window)
    same = (window[order][1:] == window[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words.doc), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    out["n_repeat_words"] = np.bincount(words.doc[covered], minlength=rows)[:rows]
    return {k: v.astype(np.int64) for k, v in out.items()}


def _distinct(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    order = sort_by_row(row, values)
    new = np.ones(len(order), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (row[order][1:] != row[order][:-1])
    return np.bincount(row[order][new], minlength=rows)[:rows]


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family, hashed n-grams of all texts in order, and where each text's end."""
    hashes, shift = words.hashes(), U(64 - FAMILY_BITS)
    pair_at = words.window_starts(2)
    pairs = np.bincount(words.doc[pair_at], minlength=len(words.counts))[: len(words.counts)]
    out = [
        ((hashes >> shift).astype(np.int64), words.first),
        ((window_hashes(hashes, 2)[pair_at] >> shift).astype(np.int64), np.concatenate(([0], np.cumsum(pairs)))),
    ]
    d = words.data.astype(np.uint32)
    if len(d) >= 4:
        four = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
        code = (four * np.uint32(0x9E3779B1)) >> np.uint32(32 - FAMILY_BITS)
    else:
        code = np.zeros(0, np.uint32)
    # Four bytes that start in a text's last three run into the next one: left out.
    sizes = np.maximum(np.diff(words.offsets) - 3, 0)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(int(ends[-1])) + np.repeat(words.offsets[:-1] - ends[:-1], sizes)
    out.append((code[at].astype(np.int64), ends))
    return out


@dataclass
class QualityModel:
    """Weights by family and hash, the intercept, and the calibration of the sum."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, words: Words) -> np.ndarray:
        total = np.full(len(words.counts), self.intercept)
        for weights, (codes, ends) in zip(self.weights, features(words)):
            sums = np.concatenate(([0], np.cumsum(weights[codes], dtype=np.float64)))[ends]
            total += np.diff(sums) / np.maximum(np.diff(ends), 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * total + self.shift, -40, 40)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's distinct features (family x hash) and their shares of the family."""
    for piece in pieces(batches):
        found = features(Words(piece.column("text")))
        codes, shares = [], []
        for i in range(piece.num_rows):
            own, weight = [], []
            for family, (values, ends) in enumerate(found):
                code, n = np.unique(values[ends[i] : ends[i + 1]], return_counts=True)
                own.append(code + (family << FAMILY_BITS))
                weight.append(n / max(1, n.sum()))
            codes.append(np.concatenate(own).astype(np.int32).tobytes())
            shares.append(np.concatenate(weight).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("quality"), pa.array(codes, pa.binary()), pa.array(shares, pa.binary())],
            names=["doc_id", "quality", "codes", "shares"],
        )


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = 2000, seed: int = 5) -> QualityModel | None:
    """A model fitted on at most about ``sample`` labelled documents, chosen by a hash of their ids.

    Whole texts count; their distinct hashed n-grams are all that reaches the driver. A
    fifth of the sample only calibrates (Platt). Labels that are null, or neither 0 nor
    1, and labels without a document count for nothing. None if there are not both kinds of rows.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total = known.count()
    if not total:
        return None
    part = min(1.0, sample / total)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int(part * (1 << 30)))
    joined = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "quality", "text")
    kind = "doc_id long, quality int, codes binary, shares binary"
    joined = joined.select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    rows = sorted(joined.mapInArrow(_counted, kind).collect(), key=lambda r: (r.doc_id, r.codes))
    if len({r.quality for r in rows}) < 2:
        return None
    y = np.array([r.quality for r in rows], np.float64)
    codes = np.concatenate([np.frombuffer(r.codes, np.int32) for r in rows])
    shares = np.concatenate([np.frombuffer(r.shares, np.float32) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r.codes) // 4 for r in rows])
    tune = np.arange(len(rows)) % 5 == 4
    if len(set(y[~tune])) < 2 or len(set(y[tune])) < 2:
        tune[:] = False
    fit = ~tune[row]
    weights, intercept = _logistic(codes[fit], shares[fit], row[fit], y, ~tune)
    score = np.bincount(row, weights[codes] * shares, len(rows)) + intercept
    slope, shift = _platt(score[tune], y[tune]) if tune.any() else (1.0, 0.0)
    return QualityModel(weights.reshape(FAMILIES, -1).astype(np.float32), float(intercept), slope, shift)


def _logistic(codes, shares, row, y, used, steps: int = 200, rate: float = 0.5, decay: float = 1e-6):
    """Adam on the mean logistic loss; ``used`` marks the rows that count."""
    size = FAMILIES << FAMILY_BITS
    w, b = np.zeros(size), 0.0
    first, second, first_b, second_b = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        score = np.bincount(row, w[codes] * shares, len(y)) + b
        error = np.where(used, 1 / (1 + np.exp(-np.clip(score, -40, 40))) - y, 0) / used.sum()
        g, g_b = np.bincount(codes, error[row] * shares, size) + decay * w, error.sum()
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        first_b, second_b = 0.9 * first_b + 0.1 * g_b, 0.99 * second_b + 0.01 * g_b * g_b
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
        b -= 0.1 * (first_b / (1 - 0.9**step)) / (np.sqrt(second_b / (1 - 0.99**step)) + 1e-7)
    return w, b


def _platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the probability of a 1, by Newton's method on smoothed targets."""
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    spread = float(score.std()) or 1.0
    x = np.stack((score / spread, np.ones(len(y))), axis=1)
    found = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -40, 40)))
        grad = x.T @ (p - target) + 1e-3 * found
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        found = found - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(found[0]) / spread, float(found[1])


def judge_quality(docs: DataFrame, model: QualityModel | None, least_quality: float = LEAST_QUALITY) -> DataFrame:
    """``doc_id``, ``n_words``, the base counts, ``base_failed``, ``quality`` and ``kept`` of every row of ``docs``.

    A text fails the base rules with fewer than 50 words, or if over 50 % of its words are
    in three-word windows it has twice or more. Others are kept if the calibrated
    probability of good quality (null without a model) is ``least_quality`` or more. A null or
    empty text has no words and fails. Repeated rows and null doc_ids come out as they are.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words = Words(piece.column("text"))
            counts = base_counts(words)
            n = counts["n_words"]
            failed = (n < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * n)
            quality = model.probability(words) if model else np.ones(len(n))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    *(pa.array(counts[k]) for k in names),
                    pa.array(failed),
                    pa.array(quality, mask=np.full(len(n), model is None)),
                    pa.array(~failed & (quality >= least_quality)),
                ],
                names=["doc_id", *names, "base_failed", "quality", "kept"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, " + "".join(f"{k} long, " for k in names) + "base_failed boolean, quality double, kept boolean"
    )
