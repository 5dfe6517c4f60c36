"""Phrase collocations: Misra-Gries summaries find every frequent n-gram, a second pass counts those exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.bpe import binaries, spans
from sampleflow.llm.graph import kept
from sampleflow.llm.words import BASES, BYTE_VALUES, LOWER, U, bytes_of, give_back, mix, pieces, span_hashes

#: Bytes that end a piece, and those that end a word only (fixed values).
ENDS_PIECE = b".,;:!?\x0a\x0b\x0c\x0d"
ENDS_WORD = b"\x20\x09"
OTHER_LANG = "und"

#: A summary names an n-gram, within its hash partition, by so many bytes of its hash.
KEY_BYTES = 5
#: N-grams that a task counts together before it hands out their summaries.
HELD_GRAMS = 3 << 19
#: Counters that a summary may always hold; more only if its partition's mass asks for it.
COUNTERS = 1 << 20
#: Text bytes for each hash partition, so that most summaries stay within ``COUNTERS``.
PARTITION_BYTES = 1 << 22
#: Bits of the filter that the frequent n-grams leave for the second pass.
FILTER_BITS = 1 << 27
TEXT_BYTES = 1 << 20

_kind = np.zeros(256, np.uint8)
_kind[list(ENDS_WORD)] = 1
_kind[list(ENDS_PIECE)] = 2


class Grams:
    """The lower-cased words of some texts, and the n-grams of neighbours within pieces."""

    def __init__(self, texts: pa.Array, langs: np.ndarray):
        raw, offsets = bytes_of(texts)
        data = LOWER[raw]
        kind = _kind[data]
        inside = kind == 0
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = offsets[:-1] < offsets[1:]
        opens[offsets[:-1][full]] = inside[offsets[:-1][full]]
        closes[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        doc = np.searchsorted(offsets, starts, "right") - 1
        breaks = np.cumsum(kind == 2)
        joined = (doc[1:] == doc[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1] - 1]) if len(starts) else np.zeros(0, bool)
        self.joined, self.lang = joined, langs[doc] if len(doc) else np.zeros(0, langs.dtype)
        self.hashes = span_hashes(BYTE_VALUES[data], starts, ends)
        # The words once more, a space after each: an n-gram is one run of bytes there.
        lengths = ends - starts
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths - 1
        self.data = np.full(int(self.ends[-1]) if len(self.ends) else 0, 0x20, np.uint8)
        if len(starts):
            spread = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)
            self.data[spread] = data[np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)]

    def of(self, size: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of ``size`` words start, and a hash of each with its language (``salt`` by language)."""
        at = np.arange(max(0, len(self.lang) - size + 1))
        for k in range(size - 1):
            at = at[self.joined[at + k]]
        sums = salt[self.lang[at]] + U(size * 2)
        for k in range(size):
            sums = mix(sums * U(0x2545F4914F6CDD1D) + self.hashes[at + k])
        return at, sums

    def words(self) -> np.ndarray:
        """A number for each word, by its bytes: equal words only have equal numbers."""
        lengths = self.ends - 1 - self.starts
        found = binaries(spans(self.data, self.starts, lengths), np.cumsum(lengths)).dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, list[str], np.ndarray]]:
    """The words of each piece of rows, its languages, and a salt for each language."""
    for piece in pieces(batches, size=TEXT_BYTES):
        langs = piece.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        values = [np.frombuffer(name.encode(), np.uint8) for name in names]
        salt = np.array([span_hashes(BYTE_VALUES[v], np.array([0]), np.array([len(v)]))[0] for v in values], U)
        yield Grams(piece.column("text"), langs.indices.to_numpy(zero_copy_only=False)), names, salt


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition, and the key within it."""
    part = hashes >> U(64 - bits) if bits else np.zeros(len(hashes), U)
    return part, (hashes >> U(64 - bits - 8 * KEY_BYTES)) & U(2 ** (8 * KEY_BYTES) - 1)


def _packed(values: np.ndarray, width: int) -> bytes:
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, width: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with its sum."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary of one hash partition: no count is too low by more than ``missed``.

    With a capacity above mass / least, ``missed`` stays below ``least``: merged summaries
    lose ``capacity + 1`` units of mass for each unit that a counter loses.
    """

    def __init__(self, capacity: int):
        self.capacity, self.missed = capacity, 0
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > COUNTERS:
            self.merge()

    def merge(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.waiting, self.held = [], 0
        self.keys, self.counts = counted(*(np.concatenate(x) for x in zip(*parts)))
        over = len(self.keys) - self.capacity
        if over > 0:
            # The largest count that does not fit goes from every counter.
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            self.missed += cut
            left = self.counts > cut
            self.keys, self.counts = self.keys[left], self.counts[left] - cut

    def survivors(self, least: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.missed >= least]


def _summaries(sizes: tuple[int, ...], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            hashes, counts = counted(np.concatenate(held), np.ones(sum(map(len, held)), np.int64))
            held.clear()
            part, keys = _places(hashes, bits)
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
            rows = {"part": [], "mass": [], "n": [], "keys": [], "counts": []}
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                rows["part"].append(int(part[a]))
                rows["mass"].append(int(counts[a:b].sum()))
                rows["n"].append(b - a)
                rows["keys"].append(_packed(np.diff(keys[a:b], prepend=U(0)), KEY_BYTES))
                rows["counts"].append(_packed(counts[a:b], 4))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

        for grams, _, salt in _batches(batches):
            held += [h for size in sizes if len(h := grams.of(size, salt)[1])]
            if sum(map(len, held)) >= HELD_GRAMS:
                yield out()
        if held:
            yield out()
        give_back()

    return run


def _frequent(least: int, slice_bits: int):
    """Of each hash partition's summaries, in order: its slice of the filter."""

    def piece_of(part: int, keys: np.ndarray) -> bytes:
        flags = np.zeros(slice_bits, bool)
        for place in filter_places(keys, slice_bits):
            flags[place] = True
        return pa.compress(np.packbits(flags).tobytes(), "zstd", asbytes=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary = None, None
        done: list[tuple[int, bytes]] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "total", "n", "keys", "counts")]
            for i in range(batch.num_rows):
                part, total, n, keys, counts = (c[i].as_py() for c in columns)
                if part != now:
                    if summary is not None:
                        done.append((now, piece_of(now, summary.survivors(least))))
                    now, summary = part, Summary(max(total // least + 1, COUNTERS))
                summary.add(np.cumsum(_unpacked(keys, n, KEY_BYTES), dtype=U), _unpacked(counts, n, 4).astype(np.int64))
        if summary is not None:
            done.append((now, piece_of(now, summary.survivors(least))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.int64()), pa.array([b for _, b in done], pa.binary())], names=["part", "bits"]
        )
        give_back()

    return run


def filter_places(keys: np.ndarray, slice_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in its partition's slice."""
    spread = mix(keys + U(BASES[1]))
    return spread % U(slice_bits), (spread >> U(32)) % U(slice_bits)


def _exact(sizes: tuple[int, ...], bits: int, slice_bits: int, filter_):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros((slice_bits << bits) // 8, np.uint8)
        for part, piece in filter_.value:
            held = pa.decompress(piece, slice_bits // 8, "zstd", asbytes=True)
            flags[part * slice_bits // 8 : (part + 1) * slice_bits // 8] = np.frombuffer(held, np.uint8)

        def has(part: np.ndarray, place: np.ndarray) -> np.ndarray:
            bit = part * U(slice_bits) + place
            return (flags[(bit >> U(3)).astype(np.int64)] >> (U(7) - (bit & U(7))).astype(np.uint8)) & 1 == 1

        def rows(names: list[str], langs: np.ndarray, phrases: pa.Array, size: int, counts: np.ndarray) -> pa.RecordBatch:
            lang = pa.array(names, pa.string()).take(pa.array(langs, pa.int64()))
            return pa.RecordBatch.from_arrays(
                [lang, phrases, pa.array(np.full(len(counts), size, np.int32)), pa.array(counts.astype(np.int64))],
                names=["lang", "phrase", "size", "n"],
            )

        for grams, names, salt in _batches(batches):
            if not names:
                continue
            said, words = np.bincount(grams.lang, minlength=len(names)), grams.words()
            yield rows(names, np.arange(len(names)), pa.array([""] * len(names)), 0, said)
            for size in sizes:
                at, hashes = grams.of(size, salt)
                part, keys = _places(hashes, bits)
                first, second = filter_places(keys, slice_bits)
                here = np.flatnonzero(has(part, first))
                here = here[has(part[here], second[here])]
                if not len(here):
                    continue
                order = here[np.argsort(hashes[here], kind="stable")]
                at = at[order]
                # Words that share a hash are told apart by their bytes; one n-gram may make several rows.
                other = grams.lang[at][1:] != grams.lang[at][:-1]
                for k in range(size):
                    word = words[at + k]
                    other |= word[1:] != word[:-1]
                heads = np.flatnonzero(np.concatenate(([True], other)))
                counts, at = np.diff(np.append(heads, len(at))), at[heads]
                lengths = grams.ends[at + size - 1] - 1 - grams.starts[at]
                text = binaries(spans(grams.data, grams.starts[at], lengths), np.cumsum(lengths)).cast(pa.string())
                yield rows(names, grams.lang[at], text, size, counts)

    return run


def phrase_counts(docs: DataFrame, least: int, longest: int) -> DataFrame:
    """``lang``, ``phrase``, ``size``, ``n``: every n-gram of up to ``longest`` words found ``least`` times or more in a language.

    And, with ``size`` 0, the number of words of each language. See ``collocations``.
    """
    spark = docs.sparkSession
    sizes = tuple(range(1, longest + 1))
    rows = docs.select(F.coalesce("lang", F.lit(OTHER_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(22, max(6, int(total // PARTITION_BYTES).bit_length()))
    slice_bits = max(8, FILTER_BITS >> bits)
    summaries = kept(
        rows.mapInArrow(_summaries(sizes, bits), "part long, mass long, n long, keys binary, counts binary"), "summaries"
    )
    mass = summaries.groupBy(F.col("part").alias("of")).agg(F.sum("mass").alias("total"))
    merged = (
        summaries.join(mass, F.col("part") == F.col("of"))
        .select("part", "total", "n", "keys", "counts")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_frequent(least, slice_bits), "part long, bits binary")
    )
    # At most of a fixed size, whatever the input: FILTER_BITS, or a byte for each hash partition.
    filter_ = spark.sparkContext.broadcast([(part, bytes(piece)) for part, piece in kept(merged, "frequent").collect()])
    found = rows.mapInArrow(_exact(sizes, bits, slice_bits, filter_), "lang string, phrase string, size int, n long")
    found = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return kept(found.where((F.col("size") == 0) | (F.col("n") >= least)), "counts")


def _words(phrase: Column, start: int, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(start), length), " ")


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, inside: int = 50) -> DataFrame:
    """The first ``top`` phrases of each language, by how far their words keep together.

    ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (occurrences), ``l`` and ``r`` (of its two
    sides at the cut that scores least), ``n`` (all words of the language) and ``score``, the
    floor of 1,000,000 a a / (l r), for phrases of 2 to ``longest`` words with ``a`` of ``least``
    or more. A cut is after the first words, ties go to the earliest. A phrase inside a longer
    candidate with at least ``inside`` percent of its occurrences goes, whether that one stays or not.
    By score, then occurrences, both descending, then phrase by UTF-8 bytes.

    A-Z are lower-cased; texts are cut at ``ENDS_PIECE``, pieces at ``ENDS_WORD``. A null text has
    no words, a null language is ``und``; a language without candidates has no row. Repeated
    rows count each time, ids and other columns are not used, an empty table gives no rows.

    First pass: n-grams by hash partition in Misra-Gries summaries, merged with a capacity above
    the partition's mass over ``least``, so that each frequent n-gram survives. Survivors mark
    two bits each in a filter of fixed size (16 MB): whatever else meets those bits costs
    work, not exactness. Second pass: n-grams in the filter are counted by their text.
    """
    counts = phrase_counts(docs, least, longest)
    said = counts.where("size = 0").select("lang", F.col("n").alias("words"))
    sides = counts.where("size > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("side"), F.col("n").alias("f"))
    phrases = counts.where("size > 1").withColumnRenamed("n", "a")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", _words(F.col("phrase"), 1, F.col("k")).alias("left"))
    cuts = cuts.select("*", F.expr("substr(phrase, length(left) + 2)").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        one = sides.withColumnRenamed("f", name)
        cuts = cuts.join(one, (cuts.lang == one.of) & (cuts[side] == one.side)).drop("of", "side")
    # Exact: 7 + 15 + 15 digits above, 15 + 15 below.
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    cuts = cuts.withColumn("score", F.expr(f"(cast(1000000 as decimal(7,0)) * {a} * {a}) div ({l} * {r})"))
    least_cut = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(least_cut).select("lang", "phrase", "size", "a", "cut.*")
    # All shorter runs of words of a longer candidate, each with its largest count.
    runs = phrases.where("size > 2").select(
        "lang", "a", "size", "phrase", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    )
    runs = runs.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    inner = F.array_join(F.slice(F.split("phrase", " "), F.col("start"), F.col("length")), " ")
    longer = runs.groupBy(F.col("lang").alias("of"), inner.alias("part")).agg(F.max("a").alias("most"))
    left = scored.join(longer, (scored.lang == longer.of) & (scored.phrase == longer.part), "left")
    left = left.where(f"most IS NULL OR 100 * most < {int(inside)} * a").drop("of", "part", "most")
    # A language's phrases in parts first: no task ranks all of a frequent language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(256))
    some = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(said, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )
