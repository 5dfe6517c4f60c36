"""Language identification by a byte convolutional network trained here, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept
from sampleflow.llm.words import LOWER, bytes_of, pieces
from sampleflow.operators.telemetry import index_percentiles

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Windows that are scored at once.
WINDOWS_AT_ONCE = 512
#: Share of labelled documents, none of them fitted, that may count as text of no learned language.
REJECTED = 0.001
#: Languages that are learned at most, the most frequent ones, and labelled documents that reach the driver.
MOST_LANGS, MOST_ROWS = 1000, 20_000
#: Code points from which made-up text of other scripts is drawn, in runs of 64.
SCRIPTS = ((0x370, 0x2000), (0x3040, 0xD7A0))


@dataclass
class Network:
    """Embeddings of bytes, filters of each width (width x embedding, filters), the last layer, and the languages."""

    langs: list[str]
    embed: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    last: np.ndarray
    last_bias: np.ndarray
    #: Whether a class besides the languages, the last one, stands for text of none of them; from which margin on it decides.
    other: bool = False
    least: float | None = None

    def tables(self) -> dict[int, tuple[np.ndarray, np.ndarray | None]]:
        """For each width what its filters give for the first two bytes, and for the bytes after them."""
        out = {}
        for width, k in self.filters.items():
            byte = [self.embed @ k[j * EMBED : (j + 1) * EMBED] for j in range(width)]
            pair = lambda a, b: (a[:, None] + b[None]).reshape(-1, FILTERS).astype(np.float32)
            out[width] = (pair(byte[0], byte[1]), pair(byte[2], byte[3]) if width == 4 else byte[2].astype(np.float32) if width == 3 else None)
        return out

    def logits(self, windows: np.ndarray, tables) -> np.ndarray:
        """For windows of bytes, by the tables alone: no embedding is looked up twice."""
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        pooled = []
        for width, (first, rest) in tables.items():
            if width == 2:
                reply = first[pairs]
            elif width == 3:
                reply = first[pairs[:, :-1]] + rest[windows[:, 2:]]
            else:
                reply = first[pairs[:, :-2]] + rest[pairs[:, 2:]]
            pooled.append(np.maximum(reply.max(axis=1) + self.biases[width], 0))
        return np.concatenate(pooled, axis=1) @ self.last + self.last_bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    windows: np.ndarray, labels: np.ndarray, langs: list[str], odds: np.ndarray | None = None, steps: int = 300, batch: int = 96, seed: int = 11
) -> Network:
    """Adam on cross entropy, windows drawn by ``odds``; max pooling sends each filter's gradient to the one place that won."""
    random = np.random.default_rng(seed)
    size = FILTERS * len(WIDTHS)
    p = {"embed": random.normal(0, 0.5, (256, EMBED)), "last": random.normal(0, 0.2, (size, len(langs))), "last_bias": np.zeros(len(langs))}
    for w in WIDTHS:
        p[f"k{w}"] = random.normal(0, (1 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        rows = random.choice(len(windows), batch, p=odds)
        x, y = windows[rows], labels[rows]
        line, filters = np.arange(batch)[:, None], np.arange(FILTERS)
        embedded, kept, pooled = p["embed"][x], {}, []
        for w in WIDTHS:
            spans = np.concatenate([embedded[:, j : WINDOW - w + 1 + j] for j in range(w)], axis=2)
            reply = spans @ p[f"k{w}"]
            best = reply.argmax(axis=1)
            value = np.maximum(reply[line, best, filters] + p[f"b{w}"], 0)
            kept[w] = (spans, best, value)
            pooled.append(value)
        hidden = np.concatenate(pooled, axis=1)
        error = softmax(hidden @ p["last"] + p["last_bias"])
        error[np.arange(batch), y] -= 1
        error /= batch
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["last"], grad["last_bias"] = hidden.T @ error, error.sum(axis=0)
        back = error @ p["last"].T
        for i, w in enumerate(WIDTHS):
            spans, best, value = kept[w]
            g = back[:, i * FILTERS : (i + 1) * FILTERS] * (value > 0)
            won = spans[line, best]  # batch, filters, width x embedding
            grad[f"k{w}"] = np.einsum("bf,bfe->ef", g, won)
            grad[f"b{w}"] = g.sum(axis=0)
            to_embed = g[:, :, None] * p[f"k{w}"].T[None]
            for j in range(w):
                np.add.at(grad["embed"], x[line, best + j], to_embed[:, :, j * EMBED : (j + 1) * EMBED])
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(langs, p["embed"], {w: p[f"k{w}"] for w in WIDTHS}, {w: p[f"b{w}"] for w in WIDTHS}, p["last"], p["last_bias"])


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into windows of bytes (A-Z lower-cased, the last one padded by 0), and how many each has."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    out = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    shift = np.concatenate(([0], np.cumsum(counts)[:-1])) * WINDOW - offsets[:-1]
    out[np.arange(len(data)) + np.repeat(shift, sizes)] = LOWER[data]
    return out.reshape(-1, WINDOW), counts


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is a multiple of 5 (a null id's text is empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _sampled(known: DataFrame, per_lang: int, seed: int) -> tuple[list[str], DataFrame]:
    """The languages of ``known``, and about ``per_lang`` rows of each, at most ``MOST_ROWS``; equal rows are one."""
    spark = known.sparkSession
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()
    per_lang = min(per_lang, max(1, MOST_ROWS // max(1, len(counts))))
    shares = spark.createDataFrame([(r.lang, min(1.0, per_lang / r.n)) for r in counts], "of string, share double")
    pick = F.xxhash64("doc_id", "text", F.lit(seed))
    chosen = known.join(F.broadcast(shares), F.col("lang") == F.col("of"))
    chosen = chosen.where(F.pmod(pick, F.lit(1 << 30)) < F.col("share") * (1 << 30))
    return sorted(r.lang for r in counts), chosen.select("doc_id", "lang", "text", pick.alias("pick"))


def train_network(docs: DataFrame, per_lang: int = 500, other: bool = False, seed: int = 11) -> Network | None:
    """A network fitted on at most about ``per_lang`` documents of each language, none of them held out.

    The documents are chosen by a hash of their ids and texts, and four windows of each at
    places chosen by that hash; this is all that reaches the driver, at most about
    ``MOST_ROWS`` documents, so of many languages fewer each. Beyond ``MOST_LANGS``
    languages the rarest are not learned: their texts get the nearest learned one. With ``other``
    a class of its own is learned from made-up windows (``other_windows``). None without labelled texts.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.char_length("text") > 0))
    langs, chosen = _sampled(known, per_lang, seed)
    if not langs:
        return None
    part = F.array(
        *(F.substr("text", (F.pmod(F.xxhash64("pick", F.lit(seed + i)), F.char_length("text")) + 1).cast("int"), F.lit(WINDOW)) for i in range(4))
    )
    rows = chosen.select("lang", part.alias("parts"), "pick").distinct().orderBy("lang", "pick", "parts").collect()
    if not rows:
        return None
    data, offsets = bytes_of(pa.array([p for r in rows for p in r.parts]))
    starts = offsets[:-1]
    kept = np.minimum(np.diff(offsets), WINDOW)
    windows = np.zeros((len(starts), WINDOW), np.uint8)
    inside = np.arange(WINDOW) < kept[:, None]
    windows[inside] = LOWER[data[np.arange(int(kept.sum())) + np.repeat(starts - (np.cumsum(kept) - kept), kept)]]
    place = {lang: i for i, lang in enumerate(langs)}
    labels = np.repeat([place[r.lang] for r in rows], 4)
    classes = langs
    if other:
        made_up = other_windows(windows, seed)
        windows = np.concatenate((windows, made_up))
        labels = np.concatenate((labels, np.full(len(made_up), len(langs))))
        classes = [*langs, UNKNOWN]
    # The smaller classes' windows come as often as the larger ones'.
    odds = (1 / np.bincount(labels, minlength=len(classes)).clip(1))[labels]
    steps = 300 * min(5, -(-len(classes) // 8))
    return replace(train(windows, labels, classes, odds / odds.sum(), steps, seed=seed), other=other)


def other_windows(windows: np.ndarray, seed: int) -> np.ndarray:
    """Windows of no language: bytes of learned windows in another order, letters at random, and letters of other scripts."""
    random = np.random.default_rng(seed)
    shuffled = random.permuted(windows[random.permutation(len(windows))[: max(64, len(windows) // 4)]], axis=1)
    out = [shuffled]
    for _ in range(max(64, len(windows) // 8)):
        letters = random.choice(np.arange(97, 123), random.integers(3, 27), replace=False).astype(np.uint8)
        row = random.choice(letters, WINDOW)
        row[random.random(WINDOW) < random.choice((0, 0.1, 0.2))] = 0x20
        low, high = SCRIPTS[int(random.integers(0, len(SCRIPTS)))]
        start = int(random.integers(low, high - 64))
        script = random.integers(start, start + 64, WINDOW)
        script[random.random(WINDOW) < random.choice((0, 0.15))] = 0x20
        foreign = np.frombuffer("".join(map(chr, script)).encode()[:WINDOW], np.uint8)
        both = np.stack((row, np.pad(foreign, (0, WINDOW - len(foreign)))))
        both[:, random.choice((12, 40, 100, WINDOW, WINDOW)) :] = 0
        out.append(both)
    return np.concatenate(out)


def calibrated(docs: DataFrame, network: Network | None) -> Network | None:
    """``network`` with the margin that all but ``REJECTED`` of the texts of all held-out labelled documents stay at or below.

    The margin is the logit of the other class above that of the likeliest language; it
    is at least 0, so a text that reads more like a language never goes. Equal texts count once.
    Only digests and margins move, and the one margin that is wanted reaches the driver.
    """
    if network is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for piece in pieces(batches):
            found = pa.array(margins(piece.column("text"), network, tables))
            yield pa.RecordBatch.from_arrays([piece.column("text_hash"), found], names=["text_hash", "margin"])

    known = docs.where(held_out(F.col("doc_id")) & F.col("lang").isin(network.langs) & F.col("text").rlike(r"\p{L}"))
    hashed = known.select(F.sha2("text", 256).alias("text_hash"), "text")
    found = hashed.mapInArrow(run, "text_hash string, margin double").groupBy("text_hash").agg(F.max("margin").alias("margin"))
    least = index_percentiles(kept(found.select("margin"), "margins"), "margin", (1 - REJECTED,)).first()
    return replace(network, least=max(0.0, least.margin) if least else np.inf)


def margins(texts: pa.Array, network: Network, tables) -> np.ndarray:
    """By how much each text's mean logit of the other class is above that of its likeliest language."""
    windows, counts = windows_of(*bytes_of(texts))
    out = np.full(len(counts), -np.inf)
    if len(windows):
        parts = range(0, len(windows), WINDOWS_AT_ONCE)
        logits = np.concatenate([network.logits(windows[i : i + WINDOWS_AT_ONCE], tables) for i in parts]).astype(np.float64)
        some = np.flatnonzero(counts > 0)
        means = np.add.reduceat(logits, (np.cumsum(counts) - counts)[some], axis=0) / counts[some][:, None]
        out[some] = means[:, -1] - means[:, :-1].max(axis=1)
    return out


def predict(texts: pa.Array, network: Network | None, tables) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    values = texts.to_pylist()
    letters = np.array([network is not None and t is not None and LETTER.search(t) is not None for t in values], bool)
    langs, scores = np.full(len(values), UNKNOWN, object), np.zeros(len(values))
    if letters.any():
        windows, counts = windows_of(*bytes_of(texts))
        parts = range(0, len(windows), WINDOWS_AT_ONCE)
        logits = np.concatenate([network.logits(windows[i : i + WINDOWS_AT_ONCE], tables) for i in parts])
        some = np.flatnonzero(counts > 0)
        starts = (np.cumsum(counts) - counts)[some]
        odds = softmax(np.add.reduceat(logits.astype(np.float64), starts, axis=0) / counts[some][:, None])
        best = odds.argmax(axis=1)
        langs[some], scores[some] = np.array(network.langs, object)[best], odds[np.arange(len(some)), best]
        langs[~letters], scores[~letters] = UNKNOWN, 0.0
    return langs, scores


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row of ``docs``, by its whole text.

    A text's score is the softmax of its windows' mean logits. ``und`` with score 0 stands
    for a text that is null, empty or without letters, and for all if there is no network.
    Only ``text`` is looked at. Repeated rows and null doc_ids come out as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else None
        for piece in pieces(batches):
            langs, scores = predict(piece.column("text"), network, tables)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(langs.tolist(), pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def known_language(docs: DataFrame, network: Network | None, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns.

    A text is recognised if it has letters and the network, trained with ``other``, does not
    find it more like no language than all but ``REJECTED`` of the held-out labelled documents,
    however many languages there are; texts of several learned languages stay. Without
    held-out documents nothing with a letter goes. With ``least`` the softmax score of the likeliest language decides instead.
    """
    if least is None and network and network.least is None:
        network = calibrated(docs, network)

    @F.arrow_udf("boolean")
    def known(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = network.tables() if network else None
        for texts in arrays:
            parts = pieces(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]))
            yield pa.array([k for p in parts for k in judge(p.column("text"), tables)], pa.bool_())

    def judge(texts: pa.Array, tables) -> list[bool]:
        if network is None:
            return [False] * len(texts)
        if least is not None:
            langs, scores = predict(texts, network, tables)
            return [bool(s >= least) and lang != UNKNOWN for lang, s in zip(langs, scores)]
        like = margins(texts, network, tables) <= network.least
        return [bool(k) and t is not None and LETTER.search(t) is not None for k, t in zip(like, texts.to_pylist())]

    return docs.where(known(F.col("text")))
