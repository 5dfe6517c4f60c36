"""Row order on distributed tables.

Spark tables carry no order, yet limits, splits, chunks and positional joins
need one.  An order here is a set of unique sort columns plus *buckets* that
follow the order: every row of a lower bucket sorts before every row of a higher
one.  Buckets are functions of row values, so a lost executor recomputes the same
answer, and each one holds a small share of the rows, so no task sees the table.

* ``with_row_pos`` - dense 0-based positions; one shuffle of the rows.
* ``rows_at`` - the order values at given ranks; reads the order columns only.
  Cutting a table at such values needs no shuffle at all.

Nulls come first. Rows with equal order values are told apart by a hash of all their
columns, so repeated keys lose no row; only rows that are equal throughout stay
interchangeable.

The order columns and whatever filters the rows are computed a few times over, so
they should be cheap to read: buckets take a count and a sample for each digit they are
cut by, bounds one count of rows by bucket and one look into the buckets they fall in.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import and_, or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_COLUMNS = ("src_file", "src_row")
TIMES = T.TimestampType | T.TimestampNTZType
SAMPLES_PER_BUCKET = 100
HASH_BUCKET_ROWS = 100_000
# How often buckets are cut further; it decides how even they are, and nothing else.
MAX_DIGITS = 12
FILE_GROUPS = 256
# Stands before every number; a missing value that is cut by is this one.
LOWEST = -1.79e308


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shuffle_buckets(df: DataFrame) -> int:
    """Four buckets per shuffle partition."""
    return max(2, 4 * shuffle_partitions(df))


def quantile_bucket(
    df: DataFrame, value: str, out: str, buckets: int
) -> tuple[DataFrame, list[float]]:
    """Add ``out``, a bucket number that grows with the numeric column ``value``.

    Buckets hold about the same number of rows.  A value that alone fills more
    than one bucket gets a bucket to itself; those values are returned as well.
    The cuts come from a sample: it decides how even the buckets are, and nothing
    that is computed with them.
    """
    values = df.select(value).where(F.col(value).isNotNull())
    rows = values.count()
    fraction = min(1.0, buckets * SAMPLES_PER_BUCKET / max(rows, 1))
    sample = values if fraction == 1.0 else values.sample(fraction, seed=1)
    ranks = [i / buckets for i in range(1, buckets)]
    cuts = sample.approxQuantile(value, ranks, 1 / (4 * buckets))
    heavy = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    edges = sorted({*cuts, *(math.nextafter(v, math.inf) for v in heavy)} - {-math.inf, math.inf})
    edges = edges or [0.0]
    bucketizer = Bucketizer(
        splits=[-math.inf, *edges, math.inf],
        inputCol=value,
        outputCol=out,
        handleInvalid="keep",
    )
    # Missing values sort first.
    return bucketizer.transform(df).withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(-1))), heavy


def _some_files(df: DataFrame) -> list[str]:
    """At most ``FILE_GROUPS`` of the files a table is read from, in order: they cut the others into groups."""
    files = df._jdf.inputFiles()
    size = len(files)
    return sorted({files[i * size // FILE_GROUPS] for i in range(FILE_GROUPS)}) if size > FILE_GROUPS else sorted(files)


def count_true(tests: list[Column]) -> Column:
    """How many of the tests hold, given that each one implies those before it."""
    if not tests:
        return F.lit(0)
    middle = len(tests) // 2
    return F.when(tests[middle], count_true(tests[middle + 1 :]) + middle + 1).otherwise(count_true(tests[:middle]))


@dataclass(frozen=True)
class FileOrder:
    """The order rows have in their files: by path, then by row within the file.

    Needs the ``src_file`` and ``src_row`` columns a scan adds on request.
    """

    block_rows: int = 1 << 18
    columns: tuple[str, ...] = FILE_COLUMNS

    def bucketed(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        block = F.floor(F.col("src_row") / F.lit(self.block_rows))
        group = count_true([F.col("src_file") >= name for name in _some_files(df)])
        return df.withColumn("_group", group).withColumn("_block", block), ["_group", "src_file", "_block"]


@dataclass(frozen=True)
class HashOrder:
    """A seeded random order: by md5 of the seed and the unique key columns."""

    key: tuple[str, ...]
    seed: int
    columns: tuple[str, ...] = ("_hash",)

    def hash_column(self) -> Column:
        # Different keys must not read the same once they are joined, nor a null like any text.
        parts = [F.col(k).cast("string") for k in self.key]
        parts = [F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for p in parts]
        parts = [F.coalesce(p, F.lit("\\N")) for p in parts]
        return F.md5(F.concat_ws("|", F.lit(str(self.seed)), *parts))

    def bucketed(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        # Digests are spread evenly: leading hex digits, four or as many as the rows need, cut into like shares.
        rows, digits = df.count(), 4
        while 16**digits * HASH_BUCKET_ROWS < rows:
            digits += 1
        out = keyed(df, self).withColumn("_bucket", F.substring("_hash", 1, digits))
        return out.withColumn("_group", F.substring("_hash", 1, 2)), ["_group", "_bucket"]


@dataclass(frozen=True)
class KeyOrder:
    """Ascending order of one or more columns, nulls first.

    Numbers, strings, binaries, booleans, dates and timestamps are accepted. A value
    that holds many rows is cut further: by what its digits leave out, then by the
    columns after it.
    """

    columns: tuple[str, ...]
    buckets: int | None = None

    def bucketed(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        buckets = self.buckets or shuffle_buckets(df)
        out, names, undecided, share = df, [], F.lit(True), None
        for column in self.columns:
            digits = _digits(df, column)
            digit = next(digits)
            while digit is not None:
                value, name = f"_digit{len(names)}", f"_bucket{len(names)}"
                out = out.withColumn(value, F.when(undecided, F.coalesce(digit, F.lit(LOWEST))))
                rows = out.where(F.col(value).isNotNull()).count()
                share = share or max(1.0, rows / buckets)
                if names and (rows < 2 * share or len(names) >= MAX_DIGITS):
                    return _undigited(out), names
                # As many buckets as make them as large as those of the first digit.
                out, heavy = quantile_bucket(out, value, name, max(2, math.ceil(rows / share)))
                names.append(name)
                if not heavy:
                    return _undigited(out), names
                undecided = F.col(value).isin(heavy)
                try:
                    digit = digits.send(out.where(undecided))
                except StopIteration:
                    break
        return _undigited(out), names


def _undigited(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_digit")])


def _digits(df: DataFrame, name: str) -> Iterator[Column]:
    """Doubles that compare, one after the other, the way the column does.

    Each stands for rows that agree in all earlier ones; those are sent in, so that
    strings can go on behind what all of them share. All digits together are exact.
    """
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType | T.BinaryType):
        bytes_ = column.cast("binary")
        at, rows = 0, df
        while True:
            # Six bytes make one exact double.
            piece = F.rpad(F.hex(F.substring(bytes_, at + 1, 6)), 12, "0")
            rows = yield F.conv(piece, 16, 10).cast("double")
            # Zero bytes read like the end of a text: its length decides.
            ends = rows.agg(F.min(bytes_).alias("low"), F.max(bytes_).alias("high")).first()
            low, high = (bytes(ends.low), bytes(ends.high)) if ends.low is not None else (b"", b"")
            if low == high:
                return
            at = max(at + 6, len(os.path.commonprefix([low, high])))
            if at >= len(high):
                yield F.octet_length(column).cast("double")
                return
    elif isinstance(kind, T.LongType | TIMES):
        number = _comparable(df, name)
        rows = yield number.cast("double")
        ends = rows.agg(F.min(number).alias("low"), F.max(number).alias("high")).first()
        if ends.low is not None and max(-ends.low, ends.high) >= 2**53:
            # One double stands for several numbers: what it leaves out tells them apart.
            yield F.coalesce(number - number.cast("double").try_cast("long"), F.lit(0)).cast("double")
    elif isinstance(kind, T.DecimalType):
        # A double, then what it leaves out, twice: some 48 digits.
        rest = column.cast(T.DecimalType(38, kind.scale))
        for _ in range(3):
            digit = rest.cast("double")
            yield digit
            rest = F.coalesce(rest - digit.try_cast(T.DecimalType(38, kind.scale)), F.lit(0)).cast(T.DecimalType(38, kind.scale))
    elif isinstance(kind, T.DateType):
        yield F.unix_date(column).cast("double")
    elif isinstance(kind, T.BooleanType):
        yield column.cast("int").cast("double")
    elif isinstance(kind, T.FloatType | T.DoubleType):
        # Minus infinity stands above a missing value, and below what is left of the numbers there.
        yield F.greatest(column.cast("double"), F.lit(-1.78e308))
        yield F.greatest(column.cast("double") / 2, F.lit(-1.7e308))
    elif isinstance(kind, T.NumericType):
        yield column.cast("double")
    else:
        raise TypeError(f"cannot order by column {name!r} of type {kind.simpleString()}")


RowOrder = FileOrder | HashOrder | KeyOrder


def _inside(order: RowOrder, buckets: list[str], tie: Sequence[str] = ()) -> WindowSpec:
    """The rows of each bucket, in order."""
    return Window.partitionBy(*buckets).orderBy(*(c for c in order.columns if c not in buckets), *tie)


def _ties(df: DataFrame, order: RowOrder) -> list[str]:
    """Columns that tell rows with equal order values apart: none where there are no such rows."""
    return [] if isinstance(order, FileOrder) else ["_tie"]


def _with_tie(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    plain = [c for c in columns if "map<" not in df.schema[c].dataType.simpleString() and "variant" not in df.schema[c].dataType.simpleString()]
    return df.withColumn("_tie", F.xxhash64(*plain))


def _group_starts(groups: DataFrame, group: str) -> DataFrame:
    """Where each group of buckets starts; their number is fixed by the session and the order, not by the data."""
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    return groups.select(group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_from"))


def _bucket_starts(counts: DataFrame, buckets: list[str]) -> DataFrame:
    """Where each bucket starts inside its group: running sums in each group apart."""
    before = Window.partitionBy(buckets[0]).orderBy(*buckets[1:] or buckets).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def with_row_pos(df: DataFrame, order: RowOrder, name: str = "row_pos") -> DataFrame:
    """Add the dense 0-based position of every row in ``order``."""
    bucketed, buckets = order.bucketed(df)
    tie = _ties(df, order)
    if tie:
        bucketed = _with_tie(bucketed, df.columns)
    # Totals of groups, then sums inside each group: nothing that grows with the table meets in one place.
    counts = bucketed.groupBy(*buckets).agg(F.count("*").alias("_rows"))
    groups = _group_starts(counts.groupBy(buckets[0]).agg(F.sum("_rows").alias("_rows")), buckets[0])
    starts = _bucket_starts(counts, buckets).join(F.broadcast(groups), buckets[0])
    starts = starts.select(*buckets, (F.col("_from") + F.col("_start")).alias("_start"))
    # Window and join share partitioning and sort order: the rows move and sort once.
    inside = _inside(order, buckets, tie)
    numbered = bucketed.withColumn("_nth", F.row_number().over(inside))
    position = F.col("_start") + F.col("_nth") - 1
    keep = [c for c in df.columns if c != name]
    return numbered.join(starts, buckets).select(*keep, position.cast("long").alias(name))


@dataclass(frozen=True)
class OrderedCounts:
    """Rows per group of buckets, in order; ``total`` is the number of rows."""

    bucketed: DataFrame
    buckets: list[str]
    order: RowOrder
    counts: list[tuple]
    total: int

    def cuts_at(self, ranks: Sequence[int]) -> dict[int, tuple] | None:
        """``rows_at``, or None if one of the ranks cuts through rows with equal order values."""
        found = self.rows_at([*ranks, *(r - 1 for r in ranks)])
        if any(r in found and r - 1 in found and _same(found[r - 1], found[r]) for r in ranks):
            return None
        return {r: found[r] for r in ranks if r in found}

    def rows_at(self, ranks: Sequence[int]) -> dict[int, tuple]:
        """The order values of the rows at the given 0-based ranks.

        Only the buckets that hold such a rank are sorted.  Ranks outside the
        table are left out of the answer.  Meant for a few hundred ranks.
        """
        asked, start, left = [], 0, sorted(r for r in set(ranks) if r >= 0)
        for group, rows in self.counts:
            while left and left[0] < start + rows:
                asked.append((group, left[0] - start, left.pop(0)))
            start += rows
        wanted = self._places(asked)
        if not wanted:
            return {}
        columns = list(self.order.columns)
        values = [_comparable(self.bucketed, c) for c in columns]
        rows = self.bucketed.select(*dict.fromkeys([*columns, *self.buckets]))
        for i, name in enumerate(self.buckets):
            # Plain value lists are what a scan can skip files by.
            rows = rows.where(F.col(name).isin(sorted({w[i] for w in wanted})))
        numbered = rows.where(_any_of(self.buckets, {w[:-1] for w in wanted})).withColumn(
            "_nth", F.row_number().over(_inside(self.order, self.buckets))
        )
        names = [*self.buckets, "_nth"]
        found = numbered.where(_any_of(names, wanted)).select(
            F.struct(*names).alias("place"), F.struct(*values).alias("values")
        )
        return {wanted[tuple(row.place)]: tuple(row.values) for row in found.collect()}


    def _places(self, asked: list[tuple]) -> dict[tuple, int]:
        """The bucket, and the place in it from 1, of each rank (group, place in the group, rank): sums of those groups only."""
        first = self.buckets[0]
        if len(self.buckets) == 1 or not asked:
            return {(group, place + 1): rank for group, place, rank in asked}
        groups = sorted({group for group, _, _ in asked})
        counts = self.bucketed.where(F.col(first).isin(groups)).groupBy(*self.buckets).agg(F.count("*").alias("_rows"))
        places = F.create_map(
            *(x for g in groups for x in (F.lit(g), F.array(*(F.struct(F.lit(p).cast("long").alias("p"), F.lit(r).cast("long").alias("r")) for a, p, r in asked if a == g))))
        )
        starts = _bucket_starts(counts, self.buckets)
        held = F.filter(places[F.col(first)], lambda x: (x["p"] >= F.col("_start")) & (x["p"] < F.col("_start") + F.col("_rows")))
        found = starts.select(*self.buckets, "_start", F.explode(held).alias("at")).collect()
        return {(*row[:-2], row.at.p - row._start + 1): row.at.r for row in found}


def _same(one: tuple, other: tuple) -> bool:
    """Equal order values, as Spark compares them: a NaN equals a NaN, a null a null."""
    return all(a == b or (a != a and b != b) for a, b in zip(one, other))


def _any_of(names: list[str], places: Iterable[tuple]) -> Column:
    """True where the named columns hold one of the given rows of values."""
    same = (reduce(and_, (F.col(n) == F.lit(v) for n, v in zip(names, place))) for place in places)
    return reduce(or_, same)


def _comparable(df: DataFrame, name: str) -> Column:
    """An order column as it reaches the driver: a timestamp as microseconds, which no time zone changes."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).alias(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), F.col(name)).alias(name)
    return F.col(name)


def _literal(value: object, kind: T.DataType) -> Column:
    """A value of ``_comparable`` as the column's own type."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(str(datetime(1970, 1, 1) + timedelta(microseconds=value))).cast(kind)
    return F.lit(value).cast(kind)


def ordered_counts(df: DataFrame, order: RowOrder) -> OrderedCounts:
    """Count the rows of every group of buckets; a fixed number of groups reaches the driver."""
    bucketed, buckets = order.bucketed(df)
    rows = bucketed.groupBy(buckets[0]).agg(F.count("*").alias("_rows")).collect()
    counts = sorted(tuple(r) for r in rows)  # groups are never null
    return OrderedCounts(bucketed, buckets, order, counts, sum(c[-1] for c in counts))


def keyed(df: DataFrame, order: RowOrder) -> DataFrame:
    """The rows with all columns that ``order`` compares; ``unkeyed`` takes them off again."""
    return df.withColumn("_hash", order.hash_column()) if isinstance(order, HashOrder) else df


def unkeyed(df: DataFrame) -> DataFrame:
    return df.drop("_hash")


def _pairs(df: DataFrame, order: RowOrder, cut: tuple) -> list[tuple[Column, Column | None, bool]]:
    """Each order column, the literal it is compared with (None for null), and whether it can be null."""
    out = []
    for name, value in zip(order.columns, cut):
        kind = T.StringType() if name == "_hash" else df.schema[name].dataType
        literal = None
        if value is not None:
            literal = _literal(value, kind)
        out.append((F.col(name), literal, isinstance(order, KeyOrder) and df.schema[name].nullable))
    return out


def at_or_after(df: DataFrame, order: RowOrder, cut: tuple) -> Column:
    """True for (keyed) rows of ``df`` at or after the row with the order values ``cut``; nulls come first."""
    test = None
    for column, value, _ in reversed(_pairs(df, order, cut)):
        if value is None:
            test = F.lit(True) if test is None else column.isNotNull() | test
        else:
            # The first conjunct alone is what a scan can skip files and row groups by.
            test = column >= value if test is None else (column >= value) & ((column > value) | test)
    return test


def before(df: DataFrame, order: RowOrder, cut: tuple) -> Column:
    """True for (keyed) rows of ``df`` before the row with the order values ``cut``; nulls come first."""
    test = None
    for column, value, nullable in reversed(_pairs(df, order, cut)):
        if value is None:
            test = F.lit(False) if test is None else column.isNull() & test
        else:
            test = column < value if test is None else (column <= value) & ((column < value) | test)
            test = column.isNull() | test if nullable else test
    return test


def before_rank(df: DataFrame, order: RowOrder, rank: int) -> DataFrame:
    """The first ``rank`` rows of ``order``; a negative rank drops that many at the end."""
    counted = ordered_counts(df, order)
    if rank < 0:
        rank = max(counted.total + rank, 0)
    if rank == 0:
        return df.limit(0)
    if rank >= counted.total:
        return df
    cuts = counted.cuts_at([rank])
    if cuts is None:
        return with_row_pos(df, order, "_pos").where(F.col("_pos") < rank).drop("_pos")
    return unkeyed(keyed(df, order).where(before(df, order, cuts[rank])))
