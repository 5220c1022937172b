"""Cutting lineage by tables in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_ROOTS: dict[str, list[str]] = {}  # folders written so far, by application


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where none is set, as in tests, a folder of our own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="crestline-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return "file://" + _LOCAL[app]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> int:
    """Deletes all tables that queries of this session have written so far and tells how many folders there were. Only once their
    results have been written or read: a result that is not may still need them."""
    roots = _ROOTS.pop(spark.sparkContext.applicationId, [])
    for root in roots:
        _delete(spark, root)
    return len(roots)


class Scratch:
    """Tables written once and read again: a lost executor costs a re-read, not a recomputation.

    ``cut`` evaluates a plan once, unlike ``checkpoint()``, which evaluates its last stage twice.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/crestline/{name}-{uuid.uuid4().hex}"
        self.written: list[str] = []
        _ROOTS.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.written)}"
        df.write.parquet(path)
        self.written.append(path)
        # the schema is known: no job to infer it
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *dfs: DataFrame) -> None:
        """Delete the files of tables that nothing will read again."""
        for df in dfs:
            for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
                if f.startswith(self.root) or f.replace("file:///", "file:/").startswith(self.root.replace("file:///", "file:/")):
                    _delete(self.spark, f)
