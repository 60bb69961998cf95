"""From raw documents to token ids in five stages, each one of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, lines, mixing, shingles, toxicity
from cartwheel.llm.common import DOCUMENT_COLUMNS
from cartwheel.llm.queries import mixing_attributes, rank_file, toxicity_model
from cartwheel.scratch import new_path, write_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def own_names(stage: Stage) -> Stage:
    """The stage with all columns beside those of documents under names that no operator uses."""

    @wraps(stage)
    def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        beside = {c: f"beside_{i}" for i, c in enumerate(docs.columns) if c not in DOCUMENT_COLUMNS}
        out = stage(spark, docs.select(*[docs[c].alias(beside.get(c, c)) for c in docs.columns]), sf_dir)
        return out.select(*[out[beside.get(c, c)].alias(c) for c in docs.columns])

    return apart


@own_names
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; what is toxic is learned from the labelled ones among them that are not held out."""
    scored = toxicity.score_texts(docs, "text", toxicity_model(docs, spark, sf_dir), score="_toxicity")
    return scored.filter("_toxicity < 0.5").select(*docs.columns)


@own_names
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the later occurrences of three lines in a row; `n_chars` is that of the text that is left.

    A document that loses its whole text is gone: an earlier one holds all of its lines.
    """
    cut = lines.drop_repeated_windows(docs, "doc_id", "text", removed="_lines_removed")
    emptied = (F.col("_lines_removed") > 0) & ~F.col("text").rlike(r"\S")
    n_chars = F.when(F.col("_lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", n_chars).select(*docs.columns)


@own_names
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word shingles of similarity 0.8 or more, the one with the smallest id.

    Rows without an id are kept; of repeated rows with one id and equal shingles one is.
    Rows with one id and other shingles are documents of their own.
    """
    groups = write_table(shingles.similar_classes(docs, "doc_id", "text", words=5, percent=80).filter("doc_id IS NOT NULL"), "pipeline-groups")
    ids = groups.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("component_id").alias("component_id")).filter("doc_id = component_id")
    single = docs.join(ids.filter("rows = 1"), "doc_id", "left_semi")
    # rows that share an id are told apart by their shingles, and equal ones stand in the order of their values
    kept = groups.filter("doc_id = component_id").select("doc_id", F.col("cls").alias("_cls"))
    repeated = shingles.with_class(docs.join(ids.filter("rows > 1"), "doc_id", "left_semi").select(*docs.columns), "text", words=5)
    repeated = repeated.join(kept, ["doc_id", "_cls"], "left_semi").groupBy("doc_id", "_cls").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return single.select(*docs.columns).unionByName(repeated).unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


@own_names
def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet tempered shares of source, language and topic at once in expectation, half of all tokens at most."""
    return mixing.mix(docs, "doc_id", "text", mixing_attributes(), meet=True).filter("_kept").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the packed ids, their number, and whether they decode to the text."""
    path, pattern = rank_file()
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha"))
    decoded = bpe.decode_ids(bpe.encode_texts(rows, "text", path, pattern), path, pattern, decoded="_decoded")
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", (F.sha2("_decoded", 256) == F.col("_sha")).alias("round_trip"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("mixing", mixed_to_targets),
    ("bpe", token_ids),
]

# SQL can express neither the toxicity scores nor the token ids: the tests hold the rows against a plain version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
