"""The batch operators on streams: candidates are scored without state, the strategy histogram by event time, groups grow batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crestline.functions.scoring import url_rules
from crestline.functions.urls import is_valid_image
from crestline.operators.components import connected_components


def stream_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def score_stream(results: DataFrame) -> DataFrame:
    """Address rules on arriving rows; stateless."""
    total = F.lit(0)
    for rule in url_rules(F.col("logo_url")).values():
        total = total + rule
    return results.where(is_valid_image(F.col("logo_url"))).withColumn("url_score", total)


def histogram_stream(results: DataFrame, late: str = "21 days", size: str = "1 day") -> DataFrame:
    """Rows per strategy and window of extraction time; rows later than the watermark are left out."""
    return results.withWatermark("extracted_at", late).groupBy(F.window("extracted_at", size), "source_strategy").agg(F.count(F.lit(1)).alias("n"))


def grow_groups(edges: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Components of all edges so far, under ``store``/<batch>: labels of the last batch are edges of the next, so a batch costs labels plus its edges, not the whole history."""
    spark = edges.sparkSession

    def step(batch: DataFrame, no: int) -> None:
        links = batch.select("src", "dst")
        if no:
            links = links.unionByName(spark.read.parquet(f"{store}/{no - 1}").select(F.col("node").alias("src"), F.col("component").alias("dst")))
        # written under the batch's own number: a repeated batch replaces itself
        connected_components(links).write.mode("overwrite").parquet(f"{store}/{no}")

    return edges.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
