"""What several training-data operators share: reading tables, hold-out marks, components of a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.scratch import drop_table, write_table

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def hold_out(key: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the id as text leaves `fold`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == fold


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the undirected links `u`, `v`.

    Large-star and small-star rounds in turn. Every round is written to the
    shared folder, so that its lineage ends there. A node with very many links
    only ever meets them in joins, which AQE may split, and in minima, which
    are taken before the shuffle too. The tables of a round go with the next one.
    """
    current = write_table(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        f"{name}-links",
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_table(
            both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-large"
        )
        large = (
            both.join(least, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = write_table(large, f"{name}-large-links")
        # every link now points from a node to a smaller one
        root = write_table(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-small")
        joined = large.join(root, "u")
        last = current
        current = write_table(
            joined.filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.select("u", F.col("m").alias("v")))
            .distinct(),
            f"{name}-small-links",
        )
        drop_table(last, least, large, root)
        # the same links again: all are stars around the smallest node
        after = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
