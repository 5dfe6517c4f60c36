"""Mixing of sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``target`` for each row of ``sources`` (``source``, ``source_size``, ``weight``).

    All sizes together are shared by weight; a share above ``max_epochs`` times its
    source's size stops there, and the excess goes to the others by weight, until none is
    above. Sources are filled by how early they are full: one is full if it would be above
    its cap with all earlier ones full. One row for each source is all that meets here.
    """
    cap = (F.col("source_size") * max_epochs).cast("decimal(38,0)")
    fill = Window.orderBy(cap.cast("double") / F.col("weight"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything).cast("decimal(38,0)") - F.coalesce(F.sum(cap).over(before), F.lit(0))
    shares = sources.select(
        "*", cap.alias("_cap"), left.alias("_left"), F.sum("weight").over(rest).cast("decimal(18,0)").alias("_weights")
    )
    full = F.col("_left") * F.col("weight") >= F.col("_cap") * F.col("_weights")
    # The share of the first source that is not full holds for all later ones.
    first = F.struct("_cap", "_left", "_weights")
    order = F.struct((F.col("_cap").cast("double") / F.col("weight")).alias("r"), F.col("source").isNull(), "source")
    level = F.min(F.when(~full, F.struct(order.alias("o"), first.alias("f")))).over(everything)["f"]
    share = (level["_left"] * F.col("weight")).cast("double") / level["_weights"].cast("double")
    target = F.when(full | level.isNull(), F.col("_cap").cast("double")).otherwise(share)
    return shares.withColumn("target", target).drop("_cap", "_left", "_weights")


def _mixed(rows: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: int) -> DataFrame:
    """``rows`` (``doc_id``, ``source``, ``text``, others) with ``size``, ``source_size``, ``target``, ``repeats``, without ``text``."""
    others = rows.columns[3:]
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    rows = rows.select("doc_id", "source", *others, word_count(F.col("text")).alias("size"), key.alias("key"))
    light = kept(rows.select("source", "size", "key", F.substring("key", 1, 3).alias("cell")), "sizes")
    cells = light.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    sources = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sources = sources.withColumn("weight", F.get(F.array(*(F.lit(w).cast("long") for w in weights)), turn))
    sources = water_fill(sources, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")
    sources = kept(sources.withColumn("whole", whole.cast("long")).withColumn("rest", rest), "sources")
    # In which cell of the seeded order a source's rest ends, then at which row of that cell.
    named = sources.select(F.col("source").alias("of"), "rest")
    up_to = Window.partitionBy("source").orderBy("cell")
    filled = cells.withColumn("before", F.sum("cell_size").over(up_to) - F.col("cell_size"))
    filled = filled.join(named, F.col("source").eqNullSafe(F.col("of"))).where("before < rest")
    last = filled.groupBy("of", "rest").agg(F.max(F.struct("cell", "before")).alias("last"))
    last = last.select("of", "rest", F.col("last.cell").alias("last_cell"), "last.before")
    ends = light.join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("cell") == F.col("last_cell")))
    # Copies of a row have one key: so many of them fit.
    ends = ends.groupBy("of", "rest", "last_cell", "before", "key", "size").agg(F.count("*").alias("n"))
    upto = F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("of").orderBy("key")) - F.col("size") * F.col("n")
    room = F.col("rest") - F.col("before") - upto
    fit = F.when(F.col("size") == 0, F.when(room >= 0, F.col("n")).otherwise(0)).otherwise(F.floor(room / F.col("size") + 0.5))
    ends = ends.select("of", "key", "last_cell", "n", F.least("n", fit).cast("long").alias("fit"))
    # A cell's own name is below every key in it and above those of earlier cells.
    ends = ends.groupBy("of").agg(F.max(F.when(F.col("fit") > 0, F.struct("key", "fit", "n"))).alias("end"), F.max("last_cell").alias("cell"))
    ends = ends.select("of", F.coalesce("end.key", "cell").alias("until"), "end.fit", (F.col("end.fit") < F.col("end.n")).alias("parted"))
    plan = sources.select(F.col("source").alias("name"), "source_size", "target", "whole")
    plan = plan.join(ends, F.col("name").eqNullSafe(F.col("of")), "left").drop("of")
    plan = small(kept(plan, "plan"))
    columns = ["doc_id", "source", *others, "size", "source_size", "target"]
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("name")))
    parted = F.coalesce(F.col("parted") & (F.col("key") == F.col("until")), F.lit(False))
    more = F.coalesce((F.col("key") <= F.col("until")).cast("long"), F.lit(0).cast("long"))
    if plan.where("parted").isEmpty():
        return planned.select(*columns, (F.col("whole") + more).alias("repeats"))
    # Some copies of a row fit, some do not: they are numbered within the scan's partitions, those by their sums.
    copies = rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    copies = copies.join(plan, F.col("source").eqNullSafe(F.col("name"))).where(parted)
    counted = kept(copies.groupBy("source", "_part").agg(F.count("*").alias("_n")), "copies")
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("_part")) - F.col("_n")
    counted = counted.select(F.col("source").alias("_of"), F.col("_part").alias("_in"), before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_at")) + F.col("_before")
    copies = copies.join(counted, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
    taken = copies.select(*columns, (F.col("whole") + (place <= F.col("fit")).cast("long")).alias("repeats"))
    return planned.where(~parted).select(*columns, (F.col("whole") + more).alias("repeats")).unionByName(taken)


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``repeats`` for every row of ``docs``: how often the mix takes it.

    Sizes are words (null text: none). Sources by code point, null last, get ``weights``
    in turn. A source that is to give r times its words gives each row floor(r) times, and
    rows in a seeded order once more until the rest is reached, to half a row: the sum is
    as near to the target as whole rows allow, and reruns agree. No row is taken more than
    ``max_epochs`` times. That order is by id and text; of copies in both, any that are as many
    as fit are taken once more. A source of empty texts has target 0 and is not taken. A
    null doc_id counts as an id. Sources that would be full together are filled by code point,
    null last. The rows that decide where a source's rest ends are those of one of 4,096 cells of the order.
    """
    return _mixed(docs.select("doc_id", "source", "text"), weights, max_epochs, seed)


def repeated(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """The mix: each row of ``docs`` as often as ``mix_sources`` says, with its own columns."""
    mixed = _mixed(docs.select("doc_id", "source", "text", F.struct("*").alias("row")), weights, max_epochs, seed)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("repeats").cast("int")))).select("row.*")
