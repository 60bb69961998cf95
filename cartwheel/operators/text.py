"""TF-IDF and embeddings over documents in long form.

A document is any number of rows (entity, text, n): `text` occurs `n` times in
the entity's document. Term counts are summed by (entity, term), so a document
is never assembled in one cell; an embedding vector has a fixed number of
buckets, which bounds the only per-entity collect.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA, HashingTF, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import EMBEDDING_DIMS, HASH_BUCKETS
from cartwheel.scratch import write_table

# the tag of sparse vectors in their stored form
SPARSE = 0


def item_documents(items: DataFrame) -> DataFrame:
    """Category path, brand and title of each item as text; items without text are skipped."""
    text = F.concat_ws(" ", F.concat_ws(" ", "category_path"), "brand", "title")
    return (
        items.filter(F.col("item_id").isNotNull())
        .select("item_id", text.alias("text"), F.lit(1).cast("bigint").alias("n"))
        .filter(F.length("text") > 0)
    )


def term_counts(docs: DataFrame, entity: str) -> DataFrame:
    """(entity, token, tf): lower-cased text split at each whitespace character."""
    tokens = F.split(F.regexp_replace(F.lower("text"), r"\s+$", ""), r"\s")
    return (
        docs.select(entity, "n", F.explode(tokens).alias("token"))
        .groupBy(entity, "token")
        .agg(F.sum("n").alias("tf"))
    )


def _weighted(counts: DataFrame, entity: str, term: str) -> DataFrame:
    """Adds df and tf * ln((m + 1) / (df + 1)) to counts that hold each (entity, term) once.

    The counts are read three times and far smaller than the documents, so they are written first.
    """
    counts = write_table(counts, "term-counts")
    documents = counts.agg(F.count_distinct(entity)).scalar()
    frequency = counts.groupBy(term).agg(F.count("*").alias("df"))
    idf = F.log((documents + 1) / (F.col("df") + 1))
    return counts.join(frequency, term).withColumn("tfidf", F.col("tf") * idf)


def tfidf_terms(docs: DataFrame, entity: str) -> DataFrame:
    return _weighted(term_counts(docs, entity), entity, "token").select(entity, "token", "tf", "df", "tfidf")


def hashed_counts(docs: DataFrame, entity: str, buckets: int = HASH_BUCKETS) -> DataFrame:
    """(entity, bucket, tf): term counts by the hash of the term.

    The library hashes each term as a document of its own; the bucket is read from
    the sparse vector as it is stored, so no row ever holds an array of all buckets.
    """
    hashing = HashingTF(inputCol="tokens", outputCol="hashed", numFeatures=buckets, binary=True)
    one_token = hashing.transform(term_counts(docs, entity).withColumn("tokens", F.array("token"))).select(entity, "tf", "hashed")
    sparse = T.StructType([T.StructField("indices", T.ArrayType(T.IntegerType()))])
    stored = write_table(one_token, "hashed-terms", T.StructType([*one_token.schema.fields[:2], T.StructField("hashed", sparse)]))
    return stored.groupBy(entity, F.col("hashed.indices")[0].alias("bucket")).agg(F.sum("tf").alias("tf"))


def hashed_tfidf(docs: DataFrame, entity: str, buckets: int = HASH_BUCKETS) -> DataFrame:
    """(entity, features): TF-IDF over hashed tokens, laid out as a sparse vector is stored."""
    counts = hashed_counts(docs, entity, buckets)
    # at most `buckets` entries per entity
    entries = F.array_sort(F.collect_list(F.struct("bucket", "tfidf"))).alias("entries")
    features = F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"),
        F.lit(buckets).alias("size"),
        F.col("entries.bucket").alias("indices"),
        F.col("entries.tfidf").alias("values"),
    )
    return _weighted(counts, entity, "bucket").groupBy(entity).agg(entries).select(entity, features.alias("features"))


def stored_vectors(hashed: DataFrame, entity: str) -> DataFrame:
    """Write hashed weights and read them back as vectors: sparse, and without a row-wise conversion."""
    schema = T.StructType([hashed.schema[entity], T.StructField("features", VectorUDT())])
    return write_table(hashed, "hashed-tfidf", schema)


def fit_basis(vectors: DataFrame, dims: int = EMBEDDING_DIMS) -> PCAModel:
    """Principal components. Executors sum the bucket covariance; the driver decomposes that fixed-size matrix."""
    return PCA(k=dims, inputCol="features", outputCol="projected").fit(vectors)


def empty_embeddings(docs: DataFrame, entity: str, prefix: str, dims: int = EMBEDDING_DIMS) -> DataFrame:
    columns = [T.StructField(f"{prefix}_{i}", T.FloatType()) for i in range(1, dims + 1)]
    return docs.sparkSession.createDataFrame([], T.StructType([docs.schema[entity], *columns]))


def project(vectors: DataFrame, basis: PCAModel, entity: str, prefix: str) -> DataFrame:
    projected = basis.transform(vectors).select(entity, vector_to_array("projected", "float32").alias("p"))
    dims = basis.getK()
    return projected.select(entity, *[F.col("p")[i].alias(f"{prefix}_{i + 1}") for i in range(dims)])


def embed(docs: DataFrame, entity: str, prefix: str, basis: PCAModel | None = None) -> DataFrame:
    """Embedding columns `prefix_1..` per entity, for documents that hold any text.

    The vectors are written once: fitting reads them twice and projecting once more. Pass a fitted `basis` to place two entities in one space.
    """
    vectors = stored_vectors(hashed_tfidf(docs, entity), entity)
    if vectors.isEmpty():
        return empty_embeddings(docs, entity, prefix)
    return project(vectors, basis or fit_basis(vectors), entity, prefix)


def embed_together(sides: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Embeddings of several kinds of entities in one space: {prefix: (documents, entity)} to {prefix: embeddings}.

    One basis is fitted to the vectors of all sides, so that products across sides mean
    something. Weights are those of each side's own documents.
    """
    vectors = {prefix: stored_vectors(hashed_tfidf(docs, entity), entity) for prefix, (docs, entity) in sides.items()}
    pooled = reduce(DataFrame.unionByName, [rows.select("features") for rows in vectors.values()])
    if pooled.isEmpty():
        return {prefix: empty_embeddings(docs, entity, prefix) for prefix, (docs, entity) in sides.items()}
    basis = fit_basis(pooled)
    return {prefix: project(vectors[prefix], basis, entity, prefix) for prefix, (_, entity) in sides.items()}
