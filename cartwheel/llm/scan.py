"""Nearest neighbours by adaptive dimension scan inside the probed lists of an inverted file."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.vectors import MOST_CENTROIDS, k_means, matrix, nearest, sample, usable
from cartwheel.scratch import write_table

# dimensions that are read between two tests
COLUMNS = 16
# strength of the tests: larger gives up fewer candidates; at 2.1 a true neighbour is lost with well under 1 % chance
EPSILON = 2.1
# rows of the sample that search it, to see how many lists must be probed, and the share of neighbours to be reached
TRIAL_QUERIES, REACHED = 500, 0.97
# candidates that a list shall hold on average, as long as the sample can tell so many lists apart
LIST_ROWS = 2048
# candidates and queries that meet in one task, and candidates between two raises of the bound
CANDIDATES, QUERIES, SEGMENT = 4096, 512, 1024


def rotation(length: int, seed: int = 11) -> np.ndarray:
    """A random rotation: after it, a few columns stand for all."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(length, length)))
    return q * np.sign(np.diag(r))


def scan_block(
    query: np.ndarray,
    query_id: int,
    turned: np.ndarray,
    rows: np.ndarray,
    spun: np.ndarray,
    norms: np.ndarray,
    ids: np.ndarray,
    k: int,
    tau: float = -np.inf,
) -> tuple[np.ndarray, np.ndarray]:
    """Those of one block that may be among the k best of one query: positions and exact products, ties to the smaller id.

    `tau` is a product that k candidates elsewhere have reached: nothing below it is returned.
    It rises as candidates are scored. `spun` holds the rotated rows in column
    blocks. An inner product above tau means a squared distance below |q|^2 + |x|^2 - 2 tau. A candidate goes as soon as
    the distance over the columns read so far, scaled to all, exceeds that by more
    than the test allows; what is left after the last column is scored exactly on
    the original vectors.
    """
    at, scores = np.zeros(0, np.int64), np.zeros(0)
    length = (query * query).sum()
    first = min(len(ids), 4 * k) if tau == -np.inf else 0
    for begin in (0, *range(first, len(ids), SEGMENT)) if first else range(0, len(ids), SEGMENT):
        end = first if first and not begin else min(begin + SEGMENT, len(ids))
        alive = np.arange(begin, end)
        if tau > -np.inf:
            alive = _survivors(alive, length + norms[begin:end] - 2 * tau, turned, spun)
        alive = alive[ids[alive] != query_id]
        exact = (rows[alive] * query).sum(axis=1)
        at, scores = np.concatenate([at, alive[exact >= tau]]), np.concatenate([scores, exact[exact >= tau]])
        best = np.lexsort((ids[at], -scores))[:k]
        at, scores = at[best], scores[best]
        if len(at) == k:
            tau = max(tau, scores[-1])
    return at, scores


def _survivors(alive: np.ndarray, limit: np.ndarray, turned: np.ndarray, spun: np.ndarray) -> np.ndarray:
    """Candidates that no test over a part of the columns rules out."""
    part, d = np.zeros(len(alive)), len(turned)
    for start in range(0, d, COLUMNS):
        seen = min(start + COLUMNS, d)
        gap = spun[start // COLUMNS][alive] - turned[start:seen]
        part += (gap * gap).sum(axis=1)
        scale = 1.0 + 1e-9 if seen == d else (1 + EPSILON / math.sqrt(seen)) ** 2 * seen / d
        stay = part <= np.maximum(limit, 0) * scale + 1e-9
        if not stay.all():
            alive, part, limit = alive[stay], part[stay], limit[stay]
        if not len(alive):
            break
    return alive


def _scan(turn: np.ndarray, k: int):
    def scan(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            rows, ids = matrix(candidates["vector"]), candidates["id"].to_numpy()
            whole = rows @ turn.T
            spun = [np.ascontiguousarray(whole[:, s : s + COLUMNS]) for s in range(0, rows.shape[1], COLUMNS)]
            norms = (rows * rows).sum(axis=1)
            asked = matrix(queries["vector"])
            turned = asked @ turn.T
            for n, (query_id, tau) in enumerate(zip(queries["id"].to_pylist(), queries["tau"].to_pylist(), strict=True)):
                at, scores = scan_block(asked[n], query_id, turned[n], rows, spun, norms, ids, k, -np.inf if tau is None else tau)
                out[0].append(np.full(len(at), query_id, np.int64))
                out[1].append(ids[at])
                out[2].append(scores)
        joined = [np.concatenate(x) if x else [] for x in out]
        return pa.table({"query_id": pa.array(joined[0], pa.int64()), "vec_id": pa.array(joined[1], pa.int64()), "score": pa.array(joined[2], pa.float64())})

    return scan


def probes_for(points: np.ndarray, centroids: np.ndarray, k: int, share: float) -> int:
    """How many lists must be probed so that `share` of the sample's own nearest neighbours lie in them."""
    asked = points[:TRIAL_QUERIES]
    products = asked @ points.T
    products[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(k, len(points) - 1)
    if k < 1:
        return len(centroids)
    near = np.argpartition(-products, k - 1, axis=1)[:, :k]
    order = np.argsort(-(asked @ centroids.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, nearest(points, centroids, False)[near], axis=1).ravel())
    return int(needed[math.ceil(share * len(needed)) - 1]) + 1


def _in_lists(rows: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """`rows` with a row per list: the nearest one, or for queries the `probes` with the largest product, numbered from the first."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column("vector"))
            lists = np.argsort(-(points @ centroids.T), axis=1, kind="stable")[:, :probes] if probes else nearest(points, centroids, False)[:, None]
            at = pa.array(np.repeat(np.arange(len(points)), lists.shape[1]))
            place = np.tile(np.arange(lists.shape[1]), len(points))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.ravel(), pa.int32()), pa.array(place, pa.int32()), batch.column("id").take(at), batch.column("vector").take(at)],
                names=["list", "place", "id", "vector"],
            )

    return rows.select("id", "vector").mapInArrow(assign, "list int, place int, id long, vector array<double>")


def _met(probing: DataFrame, stored: DataFrame, scan, name: str) -> DataFrame:
    """(query_id, vec_id, score): what the queries (list, id, vector, tau) find in their lists, block by block."""
    sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("parts"))
    asking = probing.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
    plan = write_table(sizes.join(asking, "list"), "list-plan")
    slot = F.xxhash64("id", F.lit(5))
    left = probing.join(plan, "list").select(
        "list", "id", "vector", "tau", F.pmod(slot, "turns").cast("int").alias("turn"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    right = stored.join(plan, "list").select(
        "list", "id", "vector", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.pmod(slot, "parts").cast("int").alias("part")
    )
    key = ["list", "turn", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(scan, "query_id long, vec_id long, score double")
    return write_table(found, name)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(
    df: DataFrame, vec_id: str, vector: str, queries: DataFrame, k: int = 20, lists: int | None = None, probes: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each id of `queries` among the rows of `df`.

    A query never finds a row with its own id. Ties go to the smaller id. Unusable
    vectors (see `usable`) neither search nor are found; repeated rows are found
    each on their own. An id that asks more than once asks with its smallest vector. Fewer than k candidates give all of them.

    Centroids are fitted on a bounded sample; every row is put into a list. By
    default there is a list for every LIST_ROWS rows, and as many are probed as the sample's own
    neighbours call for. A query scans its first list, then twice as many at a time, and
    takes the product of its k-th best so far along: a list returns only what reaches it. A large list is cut into blocks of candidates, and the queries that
    probe it into blocks too, so one task never holds more than a block of each.
    """
    rows = usable(df, vec_id, vector)
    asked = usable(queries, vec_id, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    picked = sample(rows)
    if not len(picked):
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = rows.count()
    lists = lists or max(1, min(MOST_CENTROIDS, len(picked) // 8, math.ceil(n / LIST_ROWS)))
    centroids = k_means(picked, lists, spherical=False)
    probes = min(len(centroids), probes or probes_for(picked, centroids, k, REACHED))
    stored = write_table(_in_lists(rows, centroids, 0), "list-rows")
    probing = write_table(_in_lists(asked, centroids, probes), "list-queries")
    scan = _scan(rotation(picked.shape[1]), k)
    found, begin = _met(probing.filter("place = 0").withColumn("tau", F.lit(None).cast("double")), stored, scan, "list-found"), 1
    while begin < probes:  # as many lists as so far and one: each round returns about k rows a query
        bounds = _ranked(found, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("tau"))
        more = _met(probing.filter(F.col("place").between(begin, 2 * begin)).join(bounds, "id", "left"), stored, scan, "list-found")
        found, begin = found.unionByName(more), 2 * begin + 1
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
