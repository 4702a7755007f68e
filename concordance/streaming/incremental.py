"""The incremental forms: answers as they arrive, late ones included.

``streamed`` reads a growing folder; ``tumbling`` counts per model and window under a
watermark; ``summaries`` keeps the latest answer of each image and model in a table by
``foreachBatch``, so a repeated or late file is merged and never doubled.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def streamed(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def tumbling(answers: DataFrame, time: str, width: str = "1 hour", lateness: str = "30 days") -> DataFrame:
    """Answers and successes per model and window; works on streams and tables alike."""
    late = answers.withWatermark(time, lateness) if answers.isStreaming else answers
    return late.groupBy(F.window(time, width).alias("w"), "model_name").agg(F.count("*").alias("answers"), F.count_if("success").alias("successes")).select(F.col("w.start").alias("window_start"), "model_name", "answers", "successes")


def latest(answers: DataFrame) -> DataFrame:
    """The last received answer of each image and model."""
    rest = F.struct("received_at", "output_id", "success", "latency_ms")
    return answers.groupBy("image_id", "model_name").agg(F.max(rest).alias("r")).select("image_id", "model_name", "r.*")


#: Buckets of the table that ``summaries`` keeps; a batch rewrites those it touches.
BUCKETS = 64


def current(spark: SparkSession, table_dir: str) -> DataFrame | None:
    """The table that ``summaries`` keeps: of every bucket what its last batch wrote; None
    before the first batch."""
    try:
        rows = spark.read.parquet(table_dir)
    except AnalysisException:
        return None
    # only folder names are read for this, a row per bucket and batch
    last = {r.bucket: r.batch for r in rows.select("bucket", "batch").distinct().groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}
    if not last:
        return None
    return rows.filter(F.struct("bucket", "batch").isin(*(F.struct(F.lit(k).alias("bucket"), F.lit(v).alias("batch")) for k, v in last.items())))


def summaries(stream: DataFrame, table_dir: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps ``latest`` up to date under ``table_dir``, which ``current`` reads.

    Images are spread over buckets; a batch reads and writes only the buckets it touches, in
    folders of its own, so a batch that runs again replaces its folders and nothing else.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = latest(batch).withColumn("bucket", F.pmod(F.xxhash64("image_id"), F.lit(buckets)).cast("int"))
        old = current(spark, table_dir)
        if old is not None:
            touched = [r.bucket for r in new.select("bucket").distinct().collect()]
            before = old.filter(F.col("bucket").isin(touched) & (F.col("batch") < number)).select(*new.columns)
            both = new.unionByName(before)
            new = latest(both.drop("bucket")).withColumn("bucket", F.pmod(F.xxhash64("image_id"), F.lit(buckets)).cast("int"))
        new.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(table_dir)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
