"""Credentials in texts, told apart by how many repositories and owners hold the same value.

A value that many owners hold is a copied example; one that a single owner
holds looks live. Candidates of every text are hashed; only hashes are
aggregated over the corpus, first to distinct (value, owner, repository), so
that a value in a third of all texts costs one row per task and holder.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.scratch import write_table


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = re.compile(rf"(?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run is found whole, so the length may stand in the pattern
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "random")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value_hash", T.BinaryType()),
    ]
)
_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_hash", pa.binary())])


def _bits_per_character(value: str) -> float:
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in map(value.count, set(value)))


def _looks_random(value: str) -> bool:
    """Digits and letters of both cases, spread evenly: what generated keys look like."""
    return (
        any(c.isdigit() for c in value)
        and any(c.islower() for c in value)
        and any(c.isupper() for c in value)
        and _bits_per_character(value) >= 3.5
    )


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def spans_of(text: str) -> list[tuple[str, int, int, bytes]]:
    """(kind, start, end, hash of the secret value) in one text, by start, then kind; code points, end exclusive.

    `random` spans are candidates only, and never overlap one of the other kinds.
    """
    found = []
    if ":" in text or "=" in text:
        # a match whose value is too short still uses up its characters
        found += [("assign", *m.span(), _digest(m[1])) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), _digest(m[0])) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span(), _digest(m[0])) for m in _HEX.finditer(text)]
    taken = [(s, e) for _, s, e, _ in found]
    for m in _RANDOM.finditer(text):
        if _looks_random(m[0]) and not any(s < m.end() and m.start() < e for s, e in taken):
            found.append(("random", *m.span(), _digest(m[0])))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(df: DataFrame, text: str, keep: dict[str, Column]) -> DataFrame:
    """The columns `keep` of every row, and the `found` spans of its text (none if NULL or empty)."""
    names = list(keep)
    rows = df.select(*[c.alias(n) for n, c in keep.items()], F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema.fields, T.StructField("found", T.ArrayType(SPAN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "value_hash"), span, strict=True)) for span in spans_of(value.as_py() or "")]
                for value in batch.column("_text")
            ]
            columns = [batch.column(n) for n in names] + [pa.array(found, pa.list_(_SPAN_ARROW))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "found"])

    return rows.mapInArrow(scan, schema)


def find_secrets(
    df: DataFrame,
    doc_id: str,
    text: str,
    repository: str,
    owner: str,
    copied_owners: int = 3,
    live_repositories: int = 2,
) -> DataFrame:
    """(doc_id, spans) of every row of `df`; spans hold kind, start, end, n_owners, n_repositories, verdict.

    verdict: `copied` if at least `copied_owners` owners hold the value,
    `owner_specific` if one owner holds it in at most `live_repositories`
    repositories, else `shared`. `random` candidates become spans only if they are
    owner-specific: an even mix of characters alone is weak evidence. A NULL owner
    or repository counts as one of its own. Repeated rows each get their spans; a
    NULL or empty text has none.
    """
    # row numbers are written down with the spans, so that later reads agree on them
    found = write_table(
        candidates(
            df,
            text,
            {"doc_id": F.col(doc_id), "repository": F.col(repository).cast("string"), "owner": F.col(owner).cast("string")},
        ).withColumn("row", F.monotonically_increasing_id()),
        "secret-candidates",
    )
    each = found.select("row", "repository", "owner", F.explode("found").alias("span")).select(
        "row", "repository", "owner", "span.*"
    )
    held = each.select("value_hash", "owner", "repository").distinct()
    by_owner = held.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    spread = by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    spread = write_table(spread, "secret-spread")
    verdict = (
        F.when(F.col("n_owners") >= copied_owners, "copied")
        .when((F.col("n_owners") == 1) & (F.col("n_repositories") <= live_repositories), "owner_specific")
        .otherwise("shared")
    )
    judged = (
        each.join(spread, "value_hash")
        .withColumn("verdict", verdict)
        .filter((F.col("kind") != "random") | (F.col("verdict") == "owner_specific"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end", "n_owners", "n_repositories", "verdict")).alias("spans"))
    )
    rank = "CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 WHEN 'hex' THEN 2 ELSE 3 END"
    in_order = (
        f"transform(array_sort(transform(spans, s -> struct(s.start AS a, {rank.replace('kind', 's.kind')} AS b, s AS s))), x -> x.s)"
    )
    return found.select("row", "doc_id").join(judged.withColumn("spans", F.expr(in_order)), "row", "left").select("doc_id", "spans")


def digest(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas; empty for none."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))
