"""Intermediate tables in the cluster's shared folder.

A written Parquet table cuts lineage, survives lost executors, and still offers
column pruning and filter pushdown to whatever reads it next.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; only a local master may fall back to its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="cartwheel-")
    return _local_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that starts in here go when it ends: what it wrote is all that later jobs read."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Write `df` once and return a scan over the written table, read as `schema` if given."""
    path = new_path(df.sparkSession, name)
    with _freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def drop_table(*tables: DataFrame) -> None:
    """Remove what `write_table` wrote, once nothing that is still to run reads it. Only folders below the shared root go."""
    for table in tables:
        spark = table.sparkSession
        to_path = spark._jvm.org.apache.hadoop.fs.Path
        root = to_path(shared_root(spark)).toUri().getPath().rstrip("/")
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = to_path(folder)
            if path.getParent().toUri().getPath() == root:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
