"""Passages of three lines that occur elsewhere too: later occurrences are cut out, whole windows at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.scratch import write_table

WINDOW = 3

# positions of the lines that hold something visible, each with two hashes of the line
_FULL_LINES = (
    "filter(transform(__line_lines, (l, i) -> struct(i AS at, xxhash64(l) AS a, xxhash64(l, 7) AS b, "
    "l RLIKE '[^ \\\\t-\\\\r]' AS full)), x -> x.full)"
)
_WINDOWS = (
    "posexplode(transform(sequence(0, size(_l) - 3), i -> struct("
    "xxhash64(_l[i].a, _l[i+1].a, _l[i+2].a) AS h, xxhash64(_l[i].b, _l[i+1].b, _l[i+2].b, 11) AS g, "
    "array(_l[i].at, _l[i+1].at, _l[i+2].at) AS covers)))"
)
# runs of neighbouring positions in the sorted list of covered ones
_STARTS = "filter(__line_gone, (x, i) -> i = 0 OR __line_gone[i - 1] < x - 1)"
_ENDS = "filter(__line_gone, (x, i) -> i = size(__line_gone) - 1 OR __line_gone[i + 1] > x + 1)"
# what lies before the first run, between two runs, and after the last
_KEPT = (
    "flatten(transform(sequence(0, size(__line_spans)), k -> slice(__line_lines, "
    "IF(k = 0, 0, __line_spans[k - 1].last + 1) + 1, "
    "IF(k < size(__line_spans), __line_spans[k].first, size(__line_lines)) - IF(k = 0, 0, __line_spans[k - 1].last + 1))))"
)


def repeated_windows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(__line_id, __line_key, __line_spans): the runs of lines, from `first` to `last` (from 0), that go from each text that loses any."""
    lines = df.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("__line_id"),
        F.xxhash64(text).alias("__line_key"),
        F.split(F.col(text), "\n", -1).alias("__line_lines"),
    )
    windows = (
        lines.select("__line_id", "__line_key", F.expr(_FULL_LINES).alias("_l"))
        .filter(F.size("_l") >= WINDOW)
        .select("__line_id", "__line_key", F.expr(_WINDOWS).alias("_at", "_w"))
        .select("__line_id", "__line_key", "_at", F.col("_w.h").alias("_h"), F.col("_w.g").alias("_g"), F.col("_w.covers").alias("_covers"))
    )
    # read twice: for the first occurrences and for the others
    windows = write_table(windows, "line-windows")
    firsts = (
        windows.groupBy("_h", "_g")
        .agg(F.count("*").alias("n"), F.min(F.struct("__line_id", "__line_key", "_at")).alias("first"))
        .filter(F.col("n") > 1)
        .select("_h", "_g", "first")
    )
    firsts = write_table(firsts, "line-firsts")
    return (
        windows.join(firsts, ["_h", "_g"])
        .filter(F.struct("__line_id", "__line_key", "_at") != F.col("first"))
        .groupBy("__line_id", "__line_key")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_covers")))).alias("__line_gone"))
        .select(
            "__line_id",
            "__line_key",
            F.expr(f"zip_with({_STARTS}, {_ENDS}, (a, b) -> struct(a AS first, b AS last))").alias("__line_spans"),
        )
    )


def drop_repeated_windows(df: DataFrame, doc_id: str, text: str, removed: str = "lines_removed") -> DataFrame:
    """`df` with the lines that later occurrences of a three-line window cover cut from `text`, and their number.

    Lines end at line feeds. Windows are three lines in a row among those that
    are not blank; overlapping windows all count. The first occurrence of a window
    in the corpus (smallest id, then position) stays; the lines that any later
    one covers go, and overlapping windows merge. Every line that goes has an
    equal line earlier in the corpus that stays. A text with fewer than three
    lines, a NULL or empty text, and blank lines stay as they are. A text whose
    lines all go becomes empty; no row is dropped. A NULL id comes before all
    others. Rows that share id and text are one document and change alike. A
    column named like the count is replaced.

    Windows are compared by 128 bits of hash. A window that a third of all texts
    hold is one row per task in the search for first occurrences, and the other
    side of a join that may be split.
    """
    df = df.drop(removed, "__line_id", "__line_key", "__line_spans", "__line_lines")
    spans = repeated_windows(df, doc_id, text)
    keyed = df.withColumns(
        {"__line_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))), "__line_key": F.xxhash64(text)}
    )
    lines = F.split(F.col(text), "\n", -1)
    return (
        keyed.join(spans, ["__line_id", "__line_key"], "left")
        .withColumn("__line_lines", F.when(F.col("__line_spans").isNotNull(), lines))
        .withColumn(text, F.when(F.col("__line_spans").isNull(), F.col(text)).otherwise(F.array_join(F.expr(_KEPT), "\n")))
        .withColumn(removed, F.coalesce(F.expr("aggregate(__line_spans, 0, (n, s) -> n + s.last - s.first + 1)"), F.lit(0)))
        .drop("__line_id", "__line_key", "__line_spans", "__line_lines")
    )


# lines and windows by plain SQL over whole lines instead of hashes
ORACLE = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), full_line AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), shifted AS (
  SELECT doc_id, k, pos AS a0, lead(pos, 1) OVER o AS a1, lead(pos, 2) OVER o AS a2,
         line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS held
  FROM full_line WINDOW o AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, a0, a1, a2
  FROM (SELECT *, row_number() OVER (PARTITION BY held ORDER BY doc_id, k) AS occurrence FROM shifted WHERE a2 IS NOT NULL)
  WHERE occurrence > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest([a0, a1, a2]) AS pos FROM later
), kept AS (
  SELECT line.doc_id, string_agg(line, chr(10) ORDER BY line.pos) FILTER (gone.pos IS NULL) AS text,
         count(gone.pos) AS n
  FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.pos = gone.pos
  GROUP BY line.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(kept.n, 0) AS INTEGER) AS lines_removed
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
