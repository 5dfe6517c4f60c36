"""Even shards with equal texts together: balanced label propagation under capacity quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small

#: Rows in a cell of ``places``: what one window partition numbers.
CELL_ROWS = 20_000


def places(df: DataFrame, by: list[str], order: list[str], name: str, cells: int) -> DataFrame:
    """``df`` with ``name``: gapless positions from 0 within ``by``, in a seeded order.

    Rows are numbered in ``cells`` hashed cells of each group; the cells' counts give every
    cell its start. No task gets more than a cell.
    """
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(F.lit(name), *order), F.lit(cells)).cast("int"))
    sizes = dealt.groupBy(*by, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(starts, [*by, "_cell"]).withColumn(name, F.col("_start") + F.col("_own")).drop(
        "_cell", "_start", "_own"
    )


def _quotas(moves: DataFrame, room: DataFrame) -> DataFrame:
    """How many rows may move from ``shard`` to ``best``: as many as move back, and a share of the room left there."""
    wanted = moves.groupBy("shard", "best").agg(F.count("*").alias("n"))
    back = wanted.select(F.col("shard").alias("best"), F.col("best").alias("shard"), F.col("n").alias("back"))
    pairs = wanted.join(back, ["shard", "best"], "left").withColumn("even", F.least("n", F.coalesce("back", F.lit(0))))
    pairs = pairs.withColumn("more", F.col("n") - F.col("even"))
    asked = F.sum("more").over(Window.partitionBy("best"))
    share = F.floor(F.least(F.lit(1.0), F.col("room") / F.greatest(asked, F.lit(1))) * F.col("more"))
    return pairs.join(room, F.col("best") == F.col("room_of")).select("shard", "best", (F.col("even") + share).alias("quota"))


def balanced_shards(docs: DataFrame, shards: int = 40, max_rounds: int = 12) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` for every row of ``docs``.

    The law is ``rows``: the shards' counts differ by one at most. Equal texts are linked.
    Linked rows start on shards in a seeded order; each round counts every group's rows by
    shard, and members elsewhere ask to move to its most frequent shard. A move is granted
    against a move back, or while linked rows leave room there. Rounds end when nothing
    moves. The other rows then fill the shards up. A group above half a shard is cut into
    parts of about that size, which are groups of their own. ``slot`` counts from 0 within
    a shard. ``size`` is the text's UTF-8 bytes (null: none) plus 16. Null texts are not
    linked. Repeated rows are rows like any other; a null doc_id is a value. Reruns agree.
    ``grown_shard`` is null: it belongs to another law. Other columns are not used.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.unhex(F.md5(text))).alias("same"),
    )
    copies = rows.groupBy("same").agg(F.count("*").alias("copies")).where("copies > 1 AND same IS NOT NULL")
    rows = rows.join(small(kept(copies, "copies")), "same", "left")
    total = docs.count()
    half = max(1, total // shards // 2)
    cells = -(-total // CELL_ROWS)
    parts = F.ceil(F.col("copies") / half)
    part = F.when(parts > 1, F.pmod(F.xxhash64("doc_id", F.lit("part")), parts)).otherwise(F.lit(0)).cast("int")
    # Rows that repeat a doc_id and its text are told apart by a running number.
    twin = F.row_number().over(Window.partitionBy("doc_id", "text_crc32").orderBy("size"))
    rows = kept(rows.withColumns({"part": part, "twin": twin}), "rows")
    order = ["doc_id", "text_crc32", "twin"]
    spark = docs.sparkSession
    each = F.lit(total // shards) + (F.col("id") < total % shards).cast("long")
    capacity = spark.range(shards).select(F.col("id").cast("int").alias("room_of"), each.alias("capacity"))

    linked = rows.where("copies IS NOT NULL")
    linked = places(linked, [], order, "start", cells).withColumn("shard", (F.col("start") % shards).cast("int")).drop("start")
    linked = kept(linked, "linked")
    for _ in range(max_rounds):
        votes = linked.groupBy("same", "part", "shard").agg(F.count("*").alias("votes"))
        best = F.max(F.struct("votes", F.xxhash64("same", "part", "shard").alias("tie"), "shard"))
        best = votes.groupBy("same", "part").agg(best["shard"].alias("best"))
        asked = linked.join(best, ["same", "part"])
        moves = asked.where("shard <> best")
        used = linked.groupBy(F.col("shard").alias("room_of")).agg(F.count("*").alias("used"))
        room = capacity.join(used, "room_of", "left").select(
            "room_of", (F.col("capacity") - F.coalesce("used", F.lit(0))).alias("room")
        )
        ranked = places(moves, ["shard", "best"], order, "rank", cells)
        granted = ranked.join(_quotas(moves, room), ["shard", "best"]).withColumn("moves", F.col("rank") < F.col("quota"))
        moved = granted.select(*rows.columns, F.when(F.col("moves"), F.col("best")).otherwise(F.col("shard")).alias("shard"), "moves")
        stay = asked.where("shard = best").select(*rows.columns, "shard", F.lit(False).alias("moves"))
        step = kept(moved.union(stay), "linked")
        linked = step.drop("moves")
        if not step.where("moves").limit(1).count():
            break

    used = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row for each shard
    free, ends = 0, []
    for shard in range(shards):
        free += total // shards + (shard < total % shards) - used.get(shard, 0)
        ends.append(free)
    others = places(rows.where("copies IS NULL"), [], order, "start", cells)
    fill = F.aggregate(F.array(*(F.lit(e).cast("long") for e in ends)), F.lit(0), lambda n, e: n + (e <= F.col("start")).cast("int"))
    others = others.select(*rows.columns, fill.alias("shard"))
    placed = linked.select(*others.columns).union(others)
    return places(placed, ["shard"], order, "slot", cells).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
