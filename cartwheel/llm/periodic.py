"""Periodic runs of words inside texts: repetitions found by uniting suffix classes from the longest common prefix down."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
# positions in one block of an ordered set
BLOCK = 512
_MIX = np.random.default_rng(13).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


class Positions:
    """An ordered set of positions in blocks of bounded length, so that a set of any size takes a position cheaply."""

    __slots__ = ("blocks", "lasts", "size")

    def __init__(self, first: int) -> None:
        self.blocks, self.lasts, self.size = [[first]], [first], 1

    def add(self, x: int) -> None:
        at = min(bisect_left(self.lasts, x), len(self.blocks) - 1)
        block = self.blocks[at]
        block.insert(bisect_left(block, x), x)
        self.lasts[at] = block[-1]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.lasts[at : at + 1] = [block[BLOCK - 1], block[-1]]

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The nearest members on either side of `x`, which is not one."""
        at = bisect_left(self.lasts, x)
        if at == len(self.blocks):
            return self.lasts[-1], None
        block = self.blocks[at]
        k = bisect_left(block, x)
        return (block[k - 1] if k else self.lasts[at - 1] if at else None), block[k]

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def repeats(words: np.ndarray, length: int) -> bool:
    """False only if no stretch of `length` words occurs twice; unequal hashes prove it."""
    n = len(words) - length + 1
    if n < 2:
        return False
    hashes = np.zeros(n, np.uint64)
    for k in range(length):
        hashes = (hashes ^ words[k : k + n].astype(np.uint64)) * _MIX[k % len(_MIX)]
        hashes ^= hashes >> np.uint64(29)
    hashes.sort()
    return bool((hashes[1:] == hashes[:-1]).any())


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the rank of each, by doubling the sorted length until all differ."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank[order] = new
        if new[-1] == n - 1:
            return order, rank
        k *= 2


def neighbour_lcp(words: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it in order (0 for the first)."""
    n, shared, lcp = len(words), 0, [0] * len(words)
    for i in range(n):
        at = rank[i]
        if not at:
            shared = 0
            continue
        j = order[at - 1]
        longest = n - max(i, j)
        while shared < longest and words[i + shared] == words[j + shared]:
            shared += 1
        lcp[at] = shared
        if shared:
            shared -= 1
    return lcp


def runs_of(words: list[int], least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period; words are numbers, equal for equal words.

    Classes of suffixes are united by decreasing length of their common prefix. A
    pair of positions that becomes neighbouring in the united set shares exactly
    that many words, so at a distance within it the pair spans a repetition that
    ends at its right border, and no smaller period fits, since a position
    between the two would have been united before. Common prefixes too short for
    a run of the least length and exponent are never united.
    """
    n, times = len(words), least_exponent - 1
    # a run of period q shares at least max(least_length, least_exponent * q) - q words with itself
    least = min(max(least_length, least_exponent * q) - q for q in range(1, least_length + 1))
    array = np.asarray(words, np.int64)
    if n < least_length or not repeats(array, least):
        return []
    order, rank = suffix_order(array)
    order = order.tolist()
    lcp = np.asarray(neighbour_lcp(words, order, rank.tolist()), np.int64)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")].tolist()
    lcp = lcp.tolist()
    parent, classes, runs = {}, {}, []

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    for edge in edges:
        shared = lcp[edge]
        a, b = find(order[edge - 1]), find(order[edge])
        large = classes.pop(a, None) or Positions(a)
        small = classes.pop(b, None) or Positions(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        parent[b] = a
        found, before = [], None
        members = list(small)
        for k, x in enumerate(members):
            left, right = large.around(x)
            if left is not None and (before is None or before < left):
                found.append((left, x))
            if right is not None and (k + 1 == len(members) or right < members[k + 1]):
                found.append((x, right))
            before = x
        for x in members:
            large.add(x)
        classes[a] = large
        for i, j in found:
            period = j - i
            if times * period <= shared and shared + period >= least_length and (not i or words[i - 1] != words[j - 1]):
                runs.append((i, shared + period, period))
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def scan_words(text: str, least_length: int, least_exponent: int) -> tuple[list[tuple[int, int, int]], bytes]:
    """The runs of a text's words, and the words that stay, joined by single spaces."""
    words = text.encode("utf-8", "surrogatepass").split()  # of bytes: ASCII white space alone
    numbers: dict[bytes, int] = {}
    runs = runs_of(list(map(numbers.setdefault, words, count())), least_length, least_exponent)
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
    return runs, b" ".join(words)


def find_runs(
    df: DataFrame, text: str, runs: str = "runs", collapsed: str = "collapsed", least_length: int = 6, least_exponent: int = 4
) -> DataFrame:
    """`df` with the `runs` of its text's words and the text `collapsed` to one period of each run.

    Words are what ASCII white space separates, numbered from 0. A run (start,
    length, period) is a stretch of at least max(least_length, least_exponent *
    period) words whose smallest period that is, and which no neighbouring word
    extends. Runs may overlap. A word goes if any run holds it after the run's
    first period; the words that stay are joined by one space. A NULL or empty
    text has no runs and collapses to an empty one. Repeated rows each get their
    own result; columns named like the two outputs are replaced.

    Each text is read whole, in memory in proportion to its length.
    """
    rows = df.drop(runs, collapsed)
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_words(value.as_py() or "", least_length, least_exponent) for value in batch.column(text)]
            listed = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found]
            columns = [*[batch.column(n) for n in names], pa.array(listed, _RUN_ARROW), pa.array([t.decode("utf-8", "surrogatepass") for _, t in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, runs, collapsed])

    return rows.mapInArrow(scan, schema)


def planted_period(doc_id: str, text: str) -> str:
    """SQL for the text, of which one in ten (by the id's checksum) has its end replaced by a period repeated at least three times."""
    h = f"crc32(coalesce(cast(`{doc_id}` AS string), ''))"
    words = f"regexp_extract_all(`{text}`, '([^\\\\x20\\\\x09-\\\\x0D]+)', 1)"
    g, n = f"floor({h} / 10)", "size(w)"
    first = f"({g} % {n})"
    period = f"(1 + floor(({n} - {first}) / (3 + {g} % 8)))"
    place = f"cast({first} + (i - {first}) % {period} AS int)"
    changed = f"transform(array({words}), w -> IF({n} = 0, `{text}`, array_join(transform(w, (x, i) -> IF(i < {first}, x, w[{place}])), ' ')))[0]"
    return f"CASE WHEN {h} % 10 = 0 AND `{text}` IS NOT NULL THEN {changed} ELSE `{text}` END"


def summary() -> dict[str, str]:
    """SQL for the columns that describe `runs` and `collapsed` in short."""
    # the greatest length / period without division; a tie leaves the earlier one in the order of start and period
    best = "aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), try_element_at(runs, 1), (a, r) -> IF(r.length * a.period > a.length * r.period, r, a))"
    return {
        "n_runs": "cast(size(runs) AS bigint)",
        "best": best,
        "runs_sha256": "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256)",
        "collapsed_sha256": "sha2(collapsed, 256)",
    }
