import math
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, PCA, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwheel.operators import text
from cartwheel.plans.queries import QUERIES

DOCS = [
    ("a", "Home Garden", 3),
    ("a", "Books", 2),
    ("b", "books", 1),
    ("b", "Electronics", 4),
    ("c", "Home Garden", 1),
    ("c", "Toys and Games", 2),
    ("d", "Electronics", 1),
    ("d", "Fashion", 5),
    ("e", "Sports", 1),
    ("f", "Music", 2),
    ("f", "Books", 7),
]
SCHEMA = "user_id string, text string, n bigint"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def assembled(docs):
    """Each document as one text, with every repeat written out."""
    repeated = F.concat_ws(" ", F.array_repeat("text", F.col("n").cast("int")))
    return docs.groupBy("user_id").agg(F.concat_ws(" ", F.collect_list(repeated)).alias("text"))


def library(assembled, dims):
    stages = [
        Tokenizer(inputCol="text", outputCol="tokens"),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=512),
        IDF(inputCol="tf", outputCol="tfidf"),
        PCA(k=dims, inputCol="tfidf", outputCol="p"),
    ]
    return Pipeline(stages=stages).fit(assembled).transform(assembled)


def test_term_weights(docs):
    rows = {(r.user_id, r.token): r for r in text.tfidf_terms(docs, "user_id").collect()}
    books = rows[("a", "books")]
    assert (books.tf, books.df) == (2, 3)
    assert books.tfidf == pytest.approx(2 * math.log(7 / 4))
    assert rows[("a", "garden")].tf == 3


def test_hashed_weights_equal_those_of_whole_documents(docs, assembled):
    ours = {r.user_id: dict(zip(*r.features[2:], strict=True)) for r in text.hashed_tfidf(docs, "user_id").collect()}
    theirs = library(assembled, 2).select("user_id", vector_to_array("tfidf").alias("v")).collect()
    assert len(theirs) == len(ours) == 6
    for row in theirs:
        expected = {i: w for i, w in enumerate(row.v) if w}
        assert {i: w for i, w in ours[row.user_id].items() if w} == pytest.approx(expected)


def test_embeddings_equal_those_of_whole_documents(docs, assembled):
    # two components: the sign of a component is free, its values are not
    weights = text.stored_vectors(text.hashed_tfidf(docs, "user_id"), "user_id")
    ours = {r.user_id: (r.e_1, r.e_2) for r in text.project(weights, text.fit_basis(weights, 2), "user_id", "e").collect()}
    theirs = {r.user_id: r.p for r in library(assembled, 2).select("user_id", vector_to_array("p").alias("p")).collect()}
    for i in (0, 1):
        signs = {math.copysign(1, ours[u][i] * theirs[u][i]) for u in ours if abs(theirs[u][i]) > 1e-6}
        assert len(signs) == 1
        for u in ours:
            assert abs(ours[u][i]) == pytest.approx(abs(theirs[u][i]), abs=1e-5)


def test_embedding_shape(docs):
    rows = text.embed(docs, "user_id", "user_behavior_emb").collect()
    assert len(rows) == 6
    assert all(len(r) == 11 and not any(math.isnan(v) for v in r[1:]) for r in rows)


def test_shared_basis(docs):
    basis = text.fit_basis(text.stored_vectors(text.hashed_tfidf(docs, "user_id"), "user_id"))
    rows = text.embed(docs.limit(3), "user_id", "e", basis)
    assert rows.columns == ["user_id", *[f"e_{i}" for i in range(1, 11)]]


def test_no_documents_give_an_empty_typed_table(docs):
    empty = text.embed(docs.filter("1 = 0"), "user_id", "user_behavior_emb")
    assert empty.count() == 0
    assert dict(empty.dtypes) == {"user_id": "string", **{f"user_behavior_emb_{i}": "float" for i in range(1, 11)}}


def test_item_documents_skip_items_without_text(spark):
    rows = [("i1", ["Books"], "b", "T 1"), ("i2", None, None, None), ("i3", None, None, "only title")]
    items = spark.createDataFrame(rows, "item_id string, category_path array<string>, brand string, title string")
    docs = {r.item_id: r.text for r in text.item_documents(items).collect()}
    assert docs.keys() == {"i1", "i3"}
    assert docs["i1"] == "Books b T 1"


def brute_vectors(rows):
    """{entity: TF-IDF vector} from (entity, token, tf), with the library's hash of each token."""
    hashing = HashingTF(numFeatures=512)
    dense = defaultdict(lambda: np.zeros(512))
    for r in rows:
        dense[r[0]][hashing.indexOf(r.token)] += r.tf
    held = sum((v > 0).astype(float) for v in dense.values())
    weights = np.log((len(dense) + 1) / (held + 1))
    return {k: v * weights for k, v in dense.items()}


def brute_basis(vectors):
    """Ten directions of greatest variance, and the variance along each."""
    values, directions = np.linalg.eigh(np.cov(np.array(vectors), rowvar=False))
    return directions[:, ::-1][:, :10], values[::-1][:10]


def found_vectors(rows, prefix):
    return {r[0]: np.array([r[f"{prefix}_{i}"] for i in range(1, 11)]) for r in rows}


@pytest.mark.parametrize("name", ["u13_user_embedding", "i9_item_embedding"])
def test_registered_embeddings_against_brute_force(spark, name):
    """Products of embeddings do not depend on the signs of the components; variances name how much each explains."""
    user = name.startswith("u13")
    entity, prefix = ("user_id", "user_behavior_emb") if user else ("item_id", "item_behavior_emb")
    terms = QUERIES["t1_tfidf_terms" if user else "t1_tfidf_item_terms"](spark, SF).select(entity, "token", "tf").collect()
    vectors, ours = brute_vectors(terms), found_vectors(QUERIES[name](spark, SF).collect(), prefix)
    assert ours.keys() == vectors.keys()
    keys = sorted(ours)
    basis, variances = brute_basis([vectors[k] for k in keys])
    found, expected = np.array([ours[k] for k in keys]), np.array([vectors[k] for k in keys]) @ basis
    assert found.var(axis=0, ddof=1) == pytest.approx(variances, rel=1e-3, abs=1e-4)
    strong = variances > 1e-3 * variances[0]
    gaps = np.abs(np.diff(variances, append=0)) > 1e-3 * variances[0]
    clear = strong & gaps & np.concatenate([[True], gaps[:-1]])
    assert clear.sum() > 2 or user  # every user of the small table has every token: weights are all zero
    assert np.abs(found[:, clear]) == pytest.approx(np.abs(expected[:, clear]), abs=1e-3 * np.abs(expected).max())


def test_a_shared_fit_is_one_basis(spark, docs):
    """Both sides are projected on the directions of all vectors together; products across sides are those of the projections."""
    items = docs.filter("user_id <> 'e'").withColumnRenamed("user_id", "item_id").unionByName(spark.createDataFrame([("z", "Books Music", 2)], "item_id string, text string, n bigint"))
    out = text.embed_together({"u": (docs, "user_id"), "i": (items, "item_id")})
    users, listed = (brute_vectors(text.term_counts(d, k).select(k, "token", "tf").collect()) for d, k in ((docs, "user_id"), (items, "item_id")))
    basis, _ = brute_basis([*users.values(), *listed.values()])
    left, right = found_vectors(out["u"].collect(), "u"), found_vectors(out["i"].collect(), "i")
    assert left.keys() == users.keys() and right.keys() == listed.keys()
    for u, v in users.items():
        for i, w in listed.items():
            assert left[u] @ right[i] == pytest.approx((v @ basis) @ (w @ basis), abs=1e-4)


def test_no_term_row_holds_all_buckets(docs):
    plan = text.hashed_counts(docs, "user_id")._jdf.queryExecution().executedPlan().toString()
    assert "vector_to_array" not in plan and "indices" in plan


def test_nothing_to_embed_together(docs):
    none = docs.filter("1 = 0")
    out = text.embed_together({"a": (none, "user_id"), "b": (none, "user_id")})
    assert out["a"].count() == out["b"].count() == 0 and "b_10" in out["b"].columns
