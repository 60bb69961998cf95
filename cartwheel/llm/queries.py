"""One registered query per training-data operator, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, cells, context_mixing, language, licenses, lines, mixing, periodic, prefix_trie, scan, secrets, shingles, toxicity
from cartwheel.llm.common import documents, embeddings, hold_out, labels

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rank_file() -> tuple[str, str]:
    """Path of the public multilingual ranks, and their pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return context_mixing.score_texts(docs, "doc_id", "text", held_out=hold_out(F.col("doc_id"), 7, 2))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", hold_out(F.col("doc_id"), 5, 0).alias("held_out"))
    model = language.fit(docs.filter("NOT held_out AND lang IS NOT NULL"), "doc_id", "text", "lang")
    return language.identify(docs.select("doc_id", "held_out", "text"), "text", model)


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled rows that are not held out."""
    return toxicity.fit(docs, "doc_id", "text", labels(spark, sf_dir), "doc_id", "toxic", ~hold_out(F.col("doc_id"), 5, 0))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", hold_out(F.col("doc_id"), 5, 0).alias("held_out"))
    scored = toxicity.score_texts(docs, "text", toxicity_model(docs, spark, sf_dir))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embeddings(spark, sf_dir)
    return scan.search(rows, "vec_id", "embedding", rows.filter(F.col("vec_id") % 20 == 0), k=20)


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    mixed = mixing.mix(docs, "doc_id", "text", mixing_attributes())
    return mixed.select(
        "doc_id",
        *[F.col(f"_by_{n}").alias(n) for n in mixing_attributes()],
        F.round("_keep_probability", 8).alias("keep_probability"),
        F.col("_kept").alias("kept"),
    )


def mixing_attributes() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}


ORACLES["op5_mixing"] = mixing.oracle({"source": "source", "lang": "lang", "topic": mixing.topic_sql()}, mixing.words_sql())


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    # each document stands for a repository, each source for an owner
    found = secrets.find_secrets(docs, "doc_id", "text", repository="doc_id", owner="source")
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.digest(base), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
        F.coalesce(F.size(F.filter("spans", lambda s: s["verdict"] == "owner_specific")), F.lit(0)).cast("long").alias("n_owner_specific"),
        F.coalesce(F.size(F.filter("spans", lambda s: s["verdict"] == "copied")), F.lit(0)).cast("long").alias("n_copied"),
    )


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.similar_documents(documents(spark, sf_dir), "doc_id", "text", words=3, percent=90)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_windows(documents(spark, sf_dir).select("doc_id", "text"), "doc_id", "text")


ORACLES["op8_line_dedup"] = lines.ORACLE


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = rank_file()
    encoded = bpe.encode_texts(documents(spark, sf_dir).select("doc_id", "text"), "text", path, pattern)
    decoded = bpe.decode_ids(encoded, path, pattern)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_copies(embeddings(spark, sf_dir), "vec_id", "embedding", "label", least_cosine=0.98)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.trie(*prefix_trie.with_shared_openings(prefix_trie.numbered_turns(rows, "conv_id", "turn", "role", "text")))


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(documents(spark, sf_dir).select("doc_id", "text"), "text")
    return found.select("doc_id", "n_words", *[F.expr(sql).alias(name) for name, sql in licenses.summary().items()])


ORACLES["op12_licenses"] = licenses.oracle()


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.expr(periodic.planted_period("doc_id", "text")).alias("text"))
    found = periodic.find_runs(docs, "text").withColumns({name: F.expr(sql) for name, sql in periodic.summary().items()})
    return found.select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")],
        F.expr("cast(floor(1000 * best.length / best.period) AS bigint)").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
