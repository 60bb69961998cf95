"""Near copies among embeddings: spherical k-means cells, blocked cosine products inside cells, one kept per group."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import components
from cartwheel.llm.vectors import MOST_CENTROIDS, k_means, matrix, nearest, sample, unit, usable
from cartwheel.scratch import write_table

# rows on either side of one product
BLOCK = 1024
# vectors a cell shall hold on average, as long as the sample can tell so many cells apart
CELL_ROWS = 512


def _memberships(reps: DataFrame, centroids: np.ndarray, least_cosine: float) -> DataFrame:
    """A row for the cell of each vector (`home`), and for each other cell that may be home to a partner.

    y with cosine(x, y) >= t has its home in cell c only if y.c >= y.h for the home
    h of x. Over all such y the largest y.(c - h) is t a + s b, where a is x.(c - h), b
    the length of c - h across x, and s the sine of the angle: where that is
    negative no partner of x lives in c.
    """
    sine = math.sqrt(1 - least_cosine**2)
    schema = "label string, cell int, home boolean, id long, copies long, vector array<double>"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = unit(matrix(batch.column("vector")))
            home = nearest(points, centroids, True)
            for start in range(0, len(points), 2048):
                x, h = points[start : start + 2048], home[start : start + 2048]
                products = x @ centroids.T
                along = products - products[np.arange(len(x)), h][:, None]
                between = 2 - 2 * (centroids @ centroids.T)[h]
                across = np.sqrt(np.maximum(between - along**2, 0))
                row, cell = np.nonzero(least_cosine * along + sine * across >= -1e-9)
                at = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").take(at),
                        pa.array(cell, pa.int32()),
                        pa.array(cell == h[row]),
                        batch.column("id").take(at),
                        batch.column("copies").take(at),
                        batch.column("vector").take(at),
                    ],
                    names=["label", "cell", "home", "id", "copies", "vector"],
                )

    return reps.mapInArrow(assign, schema)


def _compare(least_cosine: float):
    def compare(homes: pa.Table, members: pa.Table) -> pa.Table:
        """Links counted for every home row, and enough of them to connect what the block connects."""
        out = {"id": [], "links": [], "other": []}
        if homes.num_rows and members.num_rows:
            a, b = homes["id"].to_numpy(), members["id"].to_numpy()
            x, y = unit(matrix(homes["vector"])), unit(matrix(members["vector"]))
            cosine = x @ y.T
            # a product may round otherwise than a plain sum: pairs at the edge are added up again
            for i, j in np.argwhere(np.abs(cosine - least_cosine) < 1e-9):
                cosine[i, j] = math.fsum(x[i] * y[j])
            linked = (cosine >= least_cosine) & (a[:, None] != b[None, :])
            links = linked @ members["copies"].to_numpy()
            low_a, low_b = a.copy(), b.copy()
            big = np.iinfo(np.int64).max
            while True:
                new_b = np.minimum(low_b, np.where(linked, low_a[:, None], big).min(axis=0))
                new_a = np.minimum(low_a, np.where(linked, new_b[None, :], big).min(axis=1))
                if (new_a == low_a).all() and (new_b == low_b).all():
                    break
                low_a, low_b = new_a, new_b
            some, joined = links > 0, low_b != b
            out["id"] = np.concatenate([a[some], b[joined]])
            out["links"] = np.concatenate([links[some], np.zeros(joined.sum(), np.int64)])
            out["other"] = np.concatenate([low_a[some], low_b[joined]])
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return compare


def near_copies(df: DataFrame, vec_id: str, vector: str, label: str, least_cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `df`.

    Vectors are compared only under equal labels; two link when their cosine is
    `least_cosine` or more. `n_links` counts the other rows linked directly,
    `component_id` is the smallest id reachable, and the row that bears it is
    kept. Rows with a NULL label or an unusable vector (see `usable`) link with
    nothing and are kept.

    Equal vectors of a label are one class with a count, so that a vector in a
    third of all rows is compared once. Cells come from spherical k-means on a
    bounded sample; a vector also joins cells that may be home to a partner, so
    no link is lost at cell borders. A large cell is cut into blocks of rows, and
    every pair of blocks is one product; blocks give counts and a spanning set of
    links, never all pairs.
    """
    rows = usable(df, vec_id, vector, {"label": label}).withColumn("label", F.col("label").cast("string")).filter("label IS NOT NULL")
    classes = write_table(rows.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    n = classes.count()
    if n:
        picked = unit(sample(classes))
        k = max(1, min(MOST_CENTROIDS, len(picked) // 8, n // CELL_ROWS))
        centroids = k_means(picked, k, spherical=True)
        members = write_table(_memberships(classes, centroids, least_cosine), "cell-members")
        size = members.groupBy("label", "cell").agg(
            F.ceil(F.count(F.when(F.col("home"), 1)) / BLOCK).cast("int").alias("rows_in"),
            F.ceil(F.count("*") / BLOCK).cast("int").alias("columns_in"),
        )
        placed = members.join(write_table(size.filter("rows_in > 0"), "cell-sizes"), ["label", "cell"])
        slot = F.xxhash64("id", F.lit(3))
        # the two sides of the grouping come from one table: one of them gets names of its own
        homes = placed.filter("home").select(
            *[F.col(c).alias(c) for c in ("label", "cell", "id", "vector")], F.pmod(slot, "rows_in").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns_in") - 1)).alias("j")
        )
        others = placed.select(
            "label", "cell", "id", "vector", "copies", F.explode(F.sequence(F.lit(0), F.col("rows_in") - 1)).alias("i"), F.pmod(slot, "columns_in").cast("int").alias("j")
        )
        key = ["label", "cell", "i", "j"]
        found = homes.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(_compare(least_cosine), "id long, links long, other long")
        found = write_table(found, "vector-links")
    else:
        found = df.sparkSession.createDataFrame([], "id long, links long, other long")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("u"), F.col("other").alias("v")), "vector-components")
    by_class = (
        classes.join(counts, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    by_class = write_table(by_class, "vector-class-result")
    own = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    return own.join(by_class, ["label", "vector"], "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
