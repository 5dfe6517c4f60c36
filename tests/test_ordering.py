import random

import pytest
from pyspark.sql import functions as F

from sampleflow.operators import select as ops
from sampleflow.operators.ordering import (
    FileOrder,
    HashOrder,
    KeyOrder,
    before_rank,
    ordered_counts,
    with_row_pos,
)
from sampleflow.sources.tables import scan_prompts

BY_ID = KeyOrder(("id",))


def largest_bucket(df, order):
    counted = ordered_counts(df, order)
    return counted.bucketed.groupBy(*counted.buckets).count().agg(F.max("count")).first()[0]


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def numbered(spark, n):
    return spark.range(n).select((F.col("id") * 7 % max(n, 1)).alias("id"), F.lit("x").alias("t"))


@pytest.mark.parametrize("rows,parts", [(10, 3), (7, 4), (3, 5), (0, 2), (1000, 8)])
def test_splits_cover_every_row_once(spark, rows, parts):
    df = spark.range(rows)
    got = ops.split_rows(df, parts, BY_ID).collect()
    sizes = [sum(r.split_id == i for r in got) for i in range(1, parts + 1)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)
    assert [r.split_id for r in sorted(got, key=lambda r: r.id)] == sorted(r.split_id for r in got)
    bounds = ops.split_bounds(df, parts).orderBy("split_id").collect()
    assert [b.end_pos - b.start_pos for b in bounds] == sizes
    for i in range(1, parts + 1):
        part = ids(ops.select_split(df, i, parts, BY_ID))
        assert part == list(range(bounds[i - 1].start_pos, bounds[i - 1].end_pos))


def test_split_arguments(spark):
    with pytest.raises(ValueError):
        ops.split_rows(spark.range(3), 0, BY_ID)
    with pytest.raises(ValueError):
        ops.select_split(spark.range(3), 4, 3, BY_ID)


@pytest.mark.parametrize("n", [1, 5, 3000])
def test_limit(spark, n):
    df = numbered(spark, 2500)
    assert ids(ops.limit_rows(df, n, BY_ID)) == list(range(min(n, 2500)))


def test_limit_off_and_negative(spark):
    df = spark.range(20)
    assert ops.limit_rows(df, 0, BY_ID).count() == 20
    assert ops.limit_rows(df, None, BY_ID).count() == 20
    assert ids(ops.limit_rows(df, -3, BY_ID)) == list(range(17))
    assert ids(ops.limit_rows(df, -30, BY_ID)) == []


def test_positions_by_number_are_dense(spark):
    rng = random.Random(3)
    values = rng.sample(range(-(10**12), 10**12), 5000) + [10**17, 10**17 + 1, 10**17 + 2]
    df = spark.createDataFrame([(v,) for v in values], "id BIGINT").repartition(7)
    got = {r.id: r.row_pos for r in with_row_pos(df, BY_ID).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_positions_by_text(spark):
    rng = random.Random(4)
    shared = ["https://example.org/a/very/long/shared/prefix/" + str(i) for i in range(600)]
    values = sorted({"".join(rng.choices("abcé漢😀 ", k=rng.randrange(0, 9))) for _ in range(800)} | set(shared))
    df = spark.createDataFrame([(v,) for v in values], "id STRING").repartition(5)
    got = {r.id: r.row_pos for r in with_row_pos(df, BY_ID).collect()}
    want = sorted(values, key=lambda v: v.encode())
    assert got == {v: i for i, v in enumerate(want)}


def test_keys_with_a_long_shared_prefix_spread(spark):
    prefix = "https://www.example.org/" + "section/" * 8
    keys = spark.range(2000).select(F.format_string(prefix + "%06d", "id").alias("id"))
    assert largest_bucket(keys, BY_ID) < 200
    got = with_row_pos(keys, BY_ID).agg(F.sum(F.when(F.substring("id", -6, 6).cast("int") == F.col("row_pos"), 1)))
    assert got.first()[0] == 2000


def test_one_leading_value_with_a_third_of_the_rows(spark):
    rows = [(5, i) for i in range(1000)] + [(i % 200, 10_000 + i) for i in range(2000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "a BIGINT, b BIGINT").repartition(6)
    order = KeyOrder(("a", "b"))
    got = {(r.a, r.b): r.row_pos for r in with_row_pos(df, order).collect()}
    assert got == {r: i for i, r in enumerate(sorted(rows))}
    # The large value is spread over many buckets.
    assert largest_bucket(df, order) < 300
    halves = ops.split_rows(df, 2, order).groupBy("split_id").count().collect()
    assert {r["split_id"]: r["count"] for r in halves} == {1: 1500, 2: 1500}


def test_unsupported_key_type(spark):
    df = spark.createDataFrame([([1],)], "id ARRAY<INT>")
    with pytest.raises(TypeError):
        with_row_pos(df, BY_ID)


def test_file_order_over_several_files_and_blocks(spark, folder):
    path = f"{folder}/t.parquet"
    spark.range(0, 1000, 1, 5).write.parquet(path)
    df = scan_prompts(spark, path, positions=True)
    order = FileOrder(block_rows=64)
    got = {r.id: r.row_pos for r in with_row_pos(df.where("id % 3 <> 0"), order).collect()}
    kept = [i for i in range(1000) if i % 3]
    assert got == {v: i for i, v in enumerate(kept)}
    assert ids(before_rank(df.where("id % 3 <> 0"), order, 250)) == kept[:250]
    assert ids(ops.select_split(df, 2, 3, order)) == list(range(334, 667))


def test_shuffle_repeats_with_its_seed_only(spark):
    df = spark.range(500)
    a, b, c = (
        {r.id: r.row_pos for r in ops.shuffle_rows(df.repartition(p), ["id"], s).collect()}
        for p, s in [(3, 1), (9, 1), (3, 2)]
    )
    assert a == b != c
    assert sorted(a.values()) == list(range(500))


def test_train_val_split_is_exact(spark):
    for n in (1, 9, 10, 505):
        got = ops.train_val_split(spark.range(n), ["id"], 42).where("is_train").count()
        assert got == int(0.9 * n)


def test_chunks_and_workers(spark):
    chunks = ops.chunk_rows(spark.range(10), 4, BY_ID).groupBy("batch_id").count().orderBy("batch_id")
    assert [tuple(r) for r in chunks.collect()] == [(0, 4), (1, 4), (2, 2)]
    assert ops.chunk_rows(spark.range(5), 100, BY_ID).select("batch_id").distinct().count() == 1
    workers = ops.distribute_rows(spark.range(3), 5, BY_ID)
    assert [r.worker for r in workers.orderBy("id").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        ops.distribute_rows(spark.range(3), 0, BY_ID)
    with pytest.raises(ValueError):
        ops.chunk_rows(spark.range(3), 0, BY_ID)


def test_hash_order_split_of_an_empty_table(spark):
    order = HashOrder(("id",), 1)
    assert ops.select_split(spark.range(0), 1, 2, order).count() == 0
    assert with_row_pos(spark.range(0), BY_ID).count() == 0


def test_selection_plan_moves_no_rows(spark, folder):
    path = f"{folder}/t.parquet"
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path)
    plan = ops.select_split(df, 2, 4, BY_ID)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "GreaterThanOrEqual(id,250)" in plan and "LessThan(id,500)" in plan


def test_position_plan_moves_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).withColumn("wide", F.repeat(F.lit("x"), 10))
        plan = with_row_pos(df, BY_ID)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan.split("Exchange hashpartitioning(_bucket0")
    # One exchange for the rows, one for the bucket starts and one for their counts.
    assert len(above) - 1 == 3


@pytest.mark.parametrize("rows", [100, 1000, 1300])
def test_more_splits_than_are_compared(spark, rows):
    parts = ops.COMPARED_SPLITS + 44
    got = ops.split_rows(spark.range(rows), parts, BY_ID).collect()
    want = {}
    for i in range(1, parts + 1):
        for pos in range(ops.split_start(rows, parts, i), ops.split_start(rows, parts, i + 1)):
            want[pos] = i
    assert {r.id: r.split_id for r in got} == want


def test_file_order_split_reads_only_its_files(spark, folder):
    path = f"{folder}/t.parquet"
    spark.range(0, 1000, 1, 10).write.parquet(path)
    part = ops.select_split(scan_prompts(spark, path, positions=True), 3, 10, FileOrder())
    assert ids(part) == list(range(200, 300))
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("DataFilters: [")[1]
    assert filters.count("part-") >= 1 and "Exchange" not in plan
    # Both bounds stand alone, so the scan can leave out files on either side.
    text = part._jdf.queryExecution().optimizedPlan().toString()
    assert ".file_path >= " in text and ".file_path <= " in text


def test_shuffled_splits_hash_each_row_once(spark):
    df = spark.range(1000)
    split = ops.split_rows(df, 16, HashOrder(("id",), 3))
    assert split.columns == ["id", "split_id"]
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1
    sizes = [r["count"] for r in split.groupBy("split_id").count().orderBy("split_id").collect()]
    assert sizes == [63] * 8 + [62] * 8


def test_hash_keys_of_several_columns_do_not_run_together(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "b|c"), ("a\\|b", "c"), ("a", "\\|b|c"), ("", "a|b|c")]
    df = spark.createDataFrame(rows, "x STRING, y STRING")
    hashed = df.select(HashOrder(("x", "y"), 1).hash_column())
    assert hashed.distinct().count() == len(rows)


def test_null_keys_come_first_and_stay(spark):
    rows = [(None if i % 10 < 3 else i % 7, i) for i in range(100)]
    df = spark.createDataFrame(rows, "a INT, b INT")
    order = KeyOrder(("a", "b"))
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(map(tuple, ops.limit_rows(df, 50, order).collect()), key=repr) == sorted(want[:50], key=repr)
    for parts in (4, 300):
        got = {r.b: r.split_id for r in ops.split_rows(df, parts, order).collect()}
        starts = [ops.split_start(100, parts, i) for i in range(1, parts + 2)]
        assert got == {want[p][1]: i for i in range(1, parts + 1) for p in range(starts[i - 1], starts[i])}
    parts = [ops.select_split(df, i, 4, order).collect() for i in range(1, 5)]
    assert [len(p) for p in parts] == [25] * 4 and len({r.b for p in parts for r in p}) == 100


def test_repeated_keys_give_exact_sizes(spark):
    df = spark.createDataFrame([(i % 3, i % 20) for i in range(100)], "a INT, b INT")
    assert ops.limit_rows(df, 50, KeyOrder(("a",))).count() == 50
    assert [ops.select_split(df, i, 4, KeyOrder(("a",))).count() for i in range(1, 5)] == [25] * 4
    sizes = ops.split_rows(df, 7, KeyOrder(("a",))).groupBy("split_id").count().orderBy("split_id").collect()
    assert [r["count"] for r in sizes] == [15, 15, 14, 14, 14, 14, 14]
    assert ops.train_val_split(df, ["a"], 1).where("is_train").count() == 90


def test_keys_of_other_types(spark):
    from datetime import date, datetime, timedelta
    from decimal import Decimal

    n = 60
    columns = {
        "timestamp": [datetime(2024, 3, 31, 0, 30) + timedelta(minutes=7 * i, microseconds=i) for i in range(n)],
        "timestamp_ntz": [datetime(1969, 12, 31, 23, 59) + timedelta(seconds=9 * i, microseconds=i) for i in range(n)],
        "date": [date(2024, 1, 1) + timedelta(days=i) for i in range(n)],
        "boolean": [i >= n // 2 for i in range(n)],
        "binary": [bytes([i // 8, i % 8, 0]) for i in range(n)],
        "decimal(38,10)": [Decimal("1234567890123456789012345678") + Decimal(i) / 10**10 for i in range(n)],
        "long": [2**62 + i for i in range(n)],
        "double": [float("-inf"), *(float(i) for i in range(n - 2)), float("nan")],
    }
    for kind, values in columns.items():
        rows = [(None, -1), *((v, i) for i, v in enumerate(values))]
        df = spark.createDataFrame(rows, f"a {kind}, b INT").repartition(3)
        order = KeyOrder(("a", "b"))
        assert ids(ops.limit_rows(df, 40, order), "b") == list(range(-1, 39)), kind
        assert {r.b: r.row_pos for r in with_row_pos(df, order).collect()} == {i: i + 1 for i in range(-1, n)}, kind


def test_large_numbers_and_long_prefixes_are_cut_further(spark):
    big = spark.range(3000).select((F.lit(2**62) + F.col("id")).alias("id"))
    assert largest_bucket(big, BY_ID) < 400
    same = spark.range(3000).select(F.lit(2**62).alias("a"), "id")
    assert largest_bucket(same, KeyOrder(("a", "id"))) < 400
    text = spark.range(3000).select(F.format_string("x" * 500 + "%06d", "id").alias("id"))
    assert largest_bucket(text, BY_ID) < 400
    empty = spark.range(3000).select(F.lit(None).cast("int").alias("a"), "id")
    assert largest_bucket(empty, KeyOrder(("a", "id"))) < 400


def test_null_parts_of_a_hash_key_stay_apart(spark):
    rows = [(None, "x"), ("x", None), (None, None), ("\\N", "x"), ("", "x")]
    hashed = spark.createDataFrame(rows, "x STRING, y STRING").select(HashOrder(("x", "y"), 1).hash_column())
    assert hashed.distinct().count() == len(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nan_keys_give_exact_sizes(spark, kind):
    """Equal keys that are no numbers: sizes are those of ntile, and no row is lost."""
    values = [float("nan")] * 50 + [0.0, -0.0] * 5 + [float("inf"), -float("inf"), None, None] + [float(i) for i in range(36)]
    df = spark.createDataFrame(list(enumerate(values)), f"n INT, id {kind.upper()}").repartition(3)
    for n in (1, 2, 3, 12, 30, 49, 70, 99, 100, -20):
        assert ops.limit_rows(df, n, BY_ID).count() == (n if n > 0 else 80)
    for parts in (2, 4, 7):
        sizes = [100 // parts + (i < 100 % parts) for i in range(parts)]
        got = ops.split_rows(df, parts, BY_ID)
        assert [r["count"] for r in got.groupBy("split_id").count().orderBy("split_id").collect()] == sizes
        assert [ops.select_split(df, i + 1, parts, BY_ID).count() for i in range(parts)] == sizes


def test_counts_in_two_levels(spark, folder):
    """Many files: a fixed number of totals reaches the driver, whatever the number of files."""
    spark.range(3000).repartition(600, "id").write.parquet(f"{folder}/many")
    df = scan_prompts(spark, f"{folder}/many", "id", positions=True)
    counted = ordered_counts(df, FileOrder())
    files = df.select("src_file").distinct().count()
    assert files > 400 and len(counted.counts) <= 257 and counted.total == 3000
    order = [r.id for r in df.orderBy("src_file", "src_row").collect()]
    placed = {r.row_pos: r.id for r in with_row_pos(df, FileOrder()).collect()}
    assert [placed[i] for i in range(3000)] == order
    got = ops.split_rows(df, 7, FileOrder()).collect()
    split = {r.id: r.split_id for r in got}
    assert [split[i] for i in order] == [k + 1 for k in range(7) for _ in range(3000 // 7 + (k < 3000 % 7))]
