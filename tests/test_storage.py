from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sampleflow.operators.embeddings import vector_statistics
from sampleflow.operators.evaluate import join_embedding
from sampleflow.operators.sampling import preview_generate, sample_fanout
from sampleflow.sources import sinks
from sampleflow.sources.storage import bucket_table, work_dir
from sampleflow.sources.tables import read_embedding_buckets, read_embeddings, scan_prompts
from sampleflow.spec import SplitOptions
from sampleflow.streaming.incremental import incremental_save, read_prompt_stream, stage_prompts


def ids(df):
    return sorted(r.id for r in df.collect())


def test_scan_errors(spark, folder):
    with pytest.raises(FileNotFoundError):
        scan_prompts(spark, f"{folder}/gone.parquet")
    spark.range(3).write.parquet(f"{folder}/t")
    with pytest.raises(ValueError):
        scan_prompts(spark, f"{folder}/t", "question")


def test_names():
    assert sinks.split_path("a/out.parquet", SplitOptions(2, 4)) == "a/out-2-of-4.parquet"
    assert sinks.split_path("a/out.parquet", SplitOptions()) == "a/out.parquet"
    assert sinks.batch_path("a/out.parquet", 7) == "a/out_batch_0007.parquet"


def test_write_replaces_and_compresses(spark, folder):
    out = f"{folder}/o.parquet"
    sinks.write_table(spark.range(10), out)
    assert ids(sinks.write_table(spark.range(3), out)) == [0, 1, 2]
    assert list(Path(out).glob("*.snappy.parquet"))


def test_merge_batches(spark, folder):
    out = f"{folder}/o.parquet"
    paths = [sinks.write_batch(spark.range(i * 3, i * 3 + 3), out, i) for i in range(3)]
    merged = sinks.merge_batches(spark, [*paths, sinks.batch_path(out, 9)], f"{folder}/all.parquet")
    assert ids(merged) == list(range(9))
    assert not any(Path(p).exists() for p in paths) and Path(f"{folder}/all.parquet").exists()
    with pytest.warns(UserWarning):
        assert sinks.merge_batches(spark, paths, f"{folder}/none.parquet") is None
    assert not Path(f"{folder}/none.parquet").exists()


def test_merge_twelve_splits_with_one_missing(spark, folder):
    out = f"{folder}/o.parquet"
    for i in range(1, 13):
        if i != 4:
            part = spark.createDataFrame([(i,)], "id INT")
            part = part.withColumn("extra", F.lit("e")) if i == 2 else part
            sinks.write_split(part, out, SplitOptions(i, 12))
    found, missing = sinks.find_splits(spark, out, 12)
    assert [f.split("-")[-3] for f in found] == [str(i) for i in range(1, 13) if i != 4]
    assert missing == [f"{folder}/o-4-of-12.parquet"]
    with pytest.warns(UserWarning, match="missing 1"):
        merged = sinks.merge_splits(spark, out, 12)
    assert ids(merged) == [i for i in range(1, 13) if i != 4]
    assert {r.id: r.extra for r in merged.collect()}[2] == "e"
    with pytest.raises(FileNotFoundError):
        sinks.find_splits(spark, f"{folder}/other.parquet", 3)


def test_checkpoint_round_trip(spark, folder):
    path = sinks.write_checkpoint(spark.range(4), folder, "c1", {"step": 3, "done": True, "none": None})
    assert path.endswith("checkpoints/checkpoint_c1")
    df, notes = sinks.read_checkpoint(spark, path)
    assert ids(df) == [0, 1, 2, 3] and notes == {"step": "3", "done": "True", "none": "None"}
    assert sinks.write_checkpoint(df.limit(1), folder, "c1", {}, split_id=2).endswith("checkpoint_c1_split2")
    assert sinks.read_checkpoint(spark, f"{folder}/checkpoints/checkpoint_c1_split2")[1] == {}


def test_scores_and_embeddings(spark, folder):
    scores = spark.createDataFrame([("a\n\"é", 0.5), ("b", 0.25), ("b", 0.25)], "text STRING, score DOUBLE")
    got = sinks.write_scores(scores, f"{folder}/s")
    assert sorted(tuple(r) for r in got.collect()) == [("a\n\"é", 0.5), ("b", 0.25)]
    vectors = spark.createDataFrame([("a", [0.1, 0.2])], "text STRING, embedding ARRAY<DOUBLE>")
    sinks.write_embeddings(vectors, f"{folder}/e")
    assert dict(read_embeddings(spark, f"{folder}/e").dtypes)["embedding"] == "array<float>"
    with pytest.raises(ValueError):
        read_embeddings(spark, _plain(spark, folder))


def _plain(spark, folder):
    spark.range(1).write.parquet(f"{folder}/plain")
    return f"{folder}/plain"


def test_work_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(base) and a != b


def prompts(spark, n=20):
    return spark.range(n).select("id", F.concat(F.lit("q"), F.col("id").cast("string")).alias("q"))


def answer(df):
    return preview_generate(df, "q", 2)


def test_incremental_save_goes_on_where_it_stopped(spark, folder):
    df = prompts(spark)
    stage_prompts(df.where("id < 10").coalesce(1), f"{folder}/in", rows_per_file=4)
    stream = read_prompt_stream(spark, f"{folder}/in", df.schema)
    paths = (f"{folder}/out", f"{folder}/state")
    assert incremental_save(stream, answer, *paths).count() == 20
    assert incremental_save(stream, answer, *paths).count() == 20
    stage_prompts(df.where("id >= 10").coalesce(1), f"{folder}/in", rows_per_file=4)
    got = incremental_save(stream, answer, *paths)
    want = answer(df)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_incremental_save_after_a_crash(spark, folder):
    df = prompts(spark)
    stage_prompts(df.coalesce(1), f"{folder}/in", rows_per_file=5)
    stream = read_prompt_stream(spark, f"{folder}/in", df.schema)
    paths = (f"{folder}/out", f"{folder}/state")
    broken = F.when(F.col("id") == 12, F.raise_error(F.lit("crash"))).otherwise(F.col("q"))
    with pytest.raises(StreamingQueryException):
        incremental_save(stream, lambda s: answer(s.withColumn("q", broken)), *paths)
    saved = spark.read.parquet(f"{folder}/out").count()
    assert 0 < saved < 40 and saved % 10 == 0
    got = incremental_save(stream, answer, *paths)
    assert sorted((r.id, r.sample_idx) for r in got.collect()) == [(i, s) for i in range(20) for s in range(2)]


def test_incremental_save_of_nothing(spark, folder):
    df = prompts(spark)
    Path(f"{folder}/in").mkdir()
    stream = read_prompt_stream(spark, f"{folder}/in", df.schema)
    got = incremental_save(stream, answer, f"{folder}/out", f"{folder}/state")
    assert got.count() == 0 and got.columns == answer(df).columns


def test_stateless_operators_accept_a_stream(spark, folder):
    from sampleflow.functions import answers, prompts as forms, text
    from sampleflow.operators.sampling import generate, temperature_schedule
    from sampleflow.operators.select import filter_rows
    from tests.test_sampling import Echo

    df = prompts(spark)
    df.write.parquet(f"{folder}/in")
    stream = read_prompt_stream(spark, f"{folder}/in", df.schema, files_per_batch=100)

    def whole(s):
        s = filter_rows(s, "id % 2 = 0").withColumn("p", forms.build_prompt("q", "\\\\boxed{{{text}}}"))
        s = temperature_schedule(sample_fanout(s, 2), [0.1, 0.2])
        s = generate(s, Echo, "p").withColumn("clean", text.clean_text("response"))
        return s.withColumn("box", answers.boxed_answer("clean"))

    got = incremental_save(stream, whole, f"{folder}/out", f"{folder}/state").collect()
    assert len(got) == 20 and all(r.box == r.q for r in got)


def test_a_failing_write_leaves_the_old_table(spark, folder):
    """The output changes only once the new one is whole, and nothing else is left behind."""
    path = f"{folder}/table.parquet"
    sinks.write_table(spark.range(10), path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    for write in (sinks.write_table, sinks.write_scores):
        with pytest.raises(Exception):
            rows = broken if write is sinks.write_table else broken.select(F.col("id").cast("string").alias("text"), F.lit(1.0).alias("score"))
            write(rows, path)
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    assert [p.name for p in Path(folder).iterdir() if "table" in p.name] == ["table.parquet"]
    # A table can be replaced by what is read from it.
    assert sinks.write_table(spark.read.parquet(path).where("id < 3"), path).count() == 3


def test_vector_moments(spark):
    """Vectors of several lengths, with nulls, against numpy; no row is exploded."""
    rng = np.random.default_rng(3)
    rows = [[float(v) + 1e6 for v in rng.normal(size=n)] for n in (3, 3, 3, 5, 1, 8, 8)] + [[], None, [None, 1e6], [None]]
    df = spark.createDataFrame([(r,) for r in rows], "embedding ARRAY<DOUBLE>")
    got = vector_statistics(df)
    flat = np.array([v for r in rows if r for v in r if v is not None])
    row = got.first()
    assert (row.vectors, row.dim) == (9, 8) and "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert np.allclose([row.mean, row.std, row.min, row.max], [flat.mean(), flat.std(), flat.min(), flat.max()], rtol=1e-9)
    empty = vector_statistics(df.limit(0)).first()
    assert (empty.vectors, empty.mean, empty.std) == (0, None, None)


def test_vectors_in_buckets_stay(spark, folder):
    """The same rows as a plain join, and only the prompts are shuffled."""
    vectors = spark.range(500).select(F.format_string("p%d", "id").alias("text"), F.array(F.col("id").cast("float")).alias("embedding"))
    sinks.write_embedding_buckets(vectors, f"{folder}/v", 8)
    spark.sql(f"DROP TABLE {bucket_table(f'{folder}/v')}")  # as in a new session
    stored = read_embedding_buckets(spark, f"{folder}/v")
    rows = spark.range(0, 900, 3).select(F.format_string("p%d", F.col("id") % 700).alias("problem"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = join_embedding(rows, stored, strict=False)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        want = join_embedding(rows, vectors, strict=False)
        pick = lambda df: sorted((r.id, r.problem, r.embedding) for r in df.collect())
        assert pick(got) == pick(want)
        with pytest.raises(Exception, match="no embedding for"):
            join_embedding(rows, stored).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
