"""Writers (K1-K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_results(results: DataFrame, folder: str) -> None:
    """K1, K2: JSON lines and CSV with a header, one file per task."""
    results.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/json")
    flat = results.select(*(c for c, kind in results.dtypes if not kind.startswith(("array", "map", "struct", "binary"))))
    flat.write.mode("overwrite").option("header", True).csv(f"{folder}/csv")


def results_document(results: DataFrame) -> DataFrame:
    """K1 in the single-array form: one row, for results that a single document may hold."""
    return results.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*results.columns))), {"ignoreNullFields": "false", "pretty": "true"}).alias("json"))


def write_files(files: DataFrame, folder: str) -> None:
    """K3: (name, content) as parquet; names are unique per domain."""
    files.select("name", "content").write.mode("overwrite").parquet(folder)


def write_cluster_document(document: DataFrame, folder: str) -> None:
    """K4."""
    document.select(F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(folder)


def write_cluster_files(groups: DataFrame, folder: str) -> None:
    """K5: (group_id, path, ...) in the order of groups; the folder is replaced. Names tell the group, as in the original's one
    folder: most groups have one file, so a folder for each would cost more than its rows. Rows of a large group may come from many tasks."""
    named = groups.withColumn("name", F.concat_ws("_", F.col("group_id").cast("string"), F.substring_index("path", "/", -1)))
    # ranges, so a reader of some groups skips the files and row groups of the others
    named.repartitionByRange("group_id", "name").sortWithinPartitions("group_id", "name").write.mode("overwrite").parquet(folder)
