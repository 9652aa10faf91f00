"""Product-day and store-day sales roll-ups as streaming queries.

Daily sales files land in a folder; ``readStream`` picks new files up, and a
watermark on the sales date bounds the state: a (date, ...) group is emitted
once, in append mode, after the watermark passes its date, and its state is
dropped.  Checkpoints must live on shared storage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("store_id", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("quantity_sold", T.LongType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("discount_percent", T.DoubleType()), T.StructField("revenue", T.DoubleType()),
    T.StructField("cost", T.DoubleType()), T.StructField("profit", T.DoubleType()),
])


def read_sales_stream(spark: SparkSession, source_dir: str, schema: T.StructType = SALES_SCHEMA,
                      files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(source_dir)


def streaming_daily_sales(lines: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Product-day roll-up of a sales stream (same sums and means as the batch roll-up)."""
    ts = F.col("date").cast("timestamp")
    return (lines.withColumn("__ts", ts).withWatermark("__ts", lateness)
                 .groupBy("__ts", "store_id", "product_id", "category")
                 .agg(F.sum("quantity_sold").alias("quantity_sold"), F.sum("revenue").alias("sales"),
                      F.sum("cost").alias("cost"), F.sum("profit").alias("profit"),
                      F.avg("discount_percent").alias("discount_percent"),
                      F.avg("unit_price").alias("unit_price"))
                 .withColumn("date", F.to_date("__ts")).drop("__ts"))


def streaming_store_days(lines: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Store-day totals of a sales stream."""
    ts = F.col("date").cast("timestamp")
    return (lines.withColumn("__ts", ts).withWatermark("__ts", lateness)
                 .groupBy("__ts", "store_id")
                 .agg(F.sum("revenue").alias("sales"), F.sum("quantity_sold").alias("quantity_sold"),
                      F.sum("profit").alias("profit"))
                 .withColumn("date", F.to_date("__ts")).drop("__ts"))


def start_parquet_sink(df: DataFrame, out_dir: str, checkpoint_dir: str | None = None,
                       available_now: bool = True):
    """Append finished groups to parquet; the checkpoint defaults to the shared checkpoint folder."""
    spark = df.sparkSession
    if checkpoint_dir is None:
        from retailcast.session import ensure_checkpoint_dir
        checkpoint_dir = os.path.join(ensure_checkpoint_dir(spark), "streams", os.path.basename(out_dir.rstrip("/")))
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_dir)
