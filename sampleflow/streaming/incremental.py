"""Save-as-you-go: new input files become new output files, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sampleflow.sources.storage import exists


def stage_prompts(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Write a table as files of at most ``rows_per_file`` rows: the save period of a run."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_prompt_stream(
    spark: SparkSession, path: str, schema, files_per_batch: int = 1, glob: str = "*.parquet"
) -> DataFrame:
    """A folder of parquet files as a stream; files that arrive later are taken too."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", glob).parquet(path)


def incremental_save(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output_path: str,
    state_path: str,
) -> DataFrame:
    """Process what is new in the stream and append it to ``output_path``.

    Each finished micro-batch is committed, so a run that breaks off goes on after
    the last one; calling again takes only files not seen before.  Returns the
    whole output, an empty table if there was no input at all.
    """
    spark = stream.sparkSession
    result = transform(stream)
    query = (
        result.writeStream.format("parquet")
        .option("compression", "snappy")
        .option("checkpointLocation", state_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output_path)
    )
    query.awaitTermination()
    if not exists(spark, output_path):
        spark.createDataFrame([], result.schema).write.parquet(output_path)
    return spark.read.schema(result.schema).parquet(output_path)
