"""Mixing sources to target weights by iterative proportional fitting, and sampling by the calibrated weights."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.scratch import drop_table, write_table

SWEEPS = 8
# sweeps between two writes; where the marginals decide when to stop, the distance they may have and the most sweeps
WRITE_EVERY, TOLERANCE, MOST_SWEEPS = 4, 1e-6, 64
# cells that one task scales
CELLS_PER_TASK = 200_000
# the share of a value grows as its tokens to this power: 1 keeps the corpus, 0 makes all values equal
TEMPERATURE = 0.5
# the share of all tokens that the sample shall hold, and steps to find the rate that gives it
BUDGET, RATE_STEPS = 0.5, 8
# how near a sample that meets the targets comes to all tokens of the scarcest value
ROOM = 0.9

# the form a text has stands for its topic, told by marks it contains; the first that fits counts
TOPICS = (
    ("licence", ("Released under", "Licensed under", "Copyright")),
    ("contact", ("@",)),
    ("table", (" | ",)),
    ("credential", ("password", "secret", "token", "api_key", "AKIA")),
)


def topic_of(text: Column) -> Column:
    """A coarse topic by the marks in `TOPICS`, else `prose`; a NULL text is `prose`."""
    topic = F.lit("prose")
    for name, marks in reversed(TOPICS):
        for mark in marks:
            topic = F.when(text.contains(mark), name).otherwise(topic)
    return topic


def words_in(text: Column) -> Column:
    """Number of words between white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def tempered(cells: DataFrame, by: str, tokens: str, power: float) -> DataFrame:
    """(by, target): the share each value shall have, its share of tokens to `power`, normalised."""
    shares = cells.groupBy(by).agg(F.sum(tokens).alias("t")).filter(F.col("t") > 0)
    total = shares.agg(F.sum(F.pow("t", F.lit(power)))).scalar()
    return shares.select(by, (F.pow("t", F.lit(power)) / total).alias("target"))


def rake(
    cells: DataFrame,
    by: Sequence[str],
    tokens: str,
    targets: dict[str, DataFrame],
    sweeps: int = SWEEPS,
    most: float | None = None,
    within: float | None = None,
) -> DataFrame:
    """`cells` with `weight`: the share of all tokens each cell shall have so that every marginal meets its target.

    `cells` has one row per combination of `by`. A sweep scales the weights to
    the targets of each attribute in turn. Targets stand beside the cells, and a marginal is
    a sum over a window of cells, so that a sweep joins nothing and sends nothing to
    the driver. Tasks are as many as the cells call for: where one holds them all, a
    window shuffles nothing, whatever the number of shuffle partitions. Weights are
    written down after every few sweeps, so that no lineage grows, and what they replace is removed. Cells without tokens keep weight 0. Weights
    that `cells` has already are where it starts. With `most`, no cell's weight
    exceeds its tokens times that: scaling and cutting in turn come to weights
    that meet both, if there are any. With `within`, sweeps end once no marginal is further than that from its target.
    """
    current = cells if "weight" in cells.columns else cells.withColumn("weight", F.col(tokens).cast("double"))
    for name in by:
        current = current.join(targets[name].withColumnRenamed("target", f"_to{name}"), name, "left")
    columns = [c for c in current.columns if c not in {f"_to{name}" for name in by}]
    written = write_table(current, "raked-cells")
    tasks = max(1, math.ceil(written.count() / CELLS_PER_TASK))
    current = written.coalesce(tasks)
    for sweep in range(1, sweeps + 1):
        for name in by:
            scale = F.try_divide(F.col(f"_to{name}"), F.sum("weight").over(Window.partitionBy(name)))
            current = current.withColumn("weight", F.coalesce(F.col("weight") * scale, F.lit(0.0)))
            if most is not None:
                current = current.withColumn("weight", F.least("weight", F.col(tokens) * most))
        if sweep % WRITE_EVERY and sweep < sweeps:
            continue
        replaced, written = written, write_table(current, "raked-cells")
        drop_table(replaced)
        current = written.coalesce(tasks)
        if within is not None and _furthest(current, by) <= within:
            break
    return current.select(*columns)


def _furthest(cells: DataFrame, by: Sequence[str]) -> float:
    """The largest distance of a marginal from its target."""
    apart = [F.abs(F.sum("weight").over(Window.partitionBy(name)) - F.coalesce(f"_to{name}", F.lit(0.0))) for name in by]
    return cells.select(F.array(*apart).alias("apart")).agg(F.max(F.array_max("apart"))).first()[0] or 0.0


def rake_within(cells: DataFrame, by: Sequence[str], tokens: str, targets: dict[str, DataFrame], total: float, budget: float) -> DataFrame:
    """As `rake`, with weights as even as it takes for a sample of up to `budget` of the `total` tokens to meet the targets.

    No sample without repeats is larger than the scarcest value allows. Aiming a
    little below that, weights are first raked within what each cell holds, then
    without that bound, so that the marginals are met in any case.
    """
    share = budget
    for name in by:
        held = cells.groupBy(name).agg(F.sum(tokens).alias("_sum")).join(targets[name].filter("target > 0"), name)
        room = held.agg(F.min(F.col("_sum") / (F.col("target") * float(total)))).first()[0]
        share = min(share, ROOM * room) if room else share
    bounded = rake(cells, by, tokens, targets, MOST_SWEEPS, 1 / (share * total), within=TOLERANCE)
    return rake(bounded, by, tokens, targets, MOST_SWEEPS, within=TOLERANCE)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that follows from the key alone, so that a lost task draws the same again."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") / float(16**12)


def mix(
    df: DataFrame,
    doc_id: str,
    text: str,
    by: dict[str, Column],
    power: float = TEMPERATURE,
    sweeps: int = SWEEPS,
    budget: float = BUDGET,
    seed: int = 17,
    targets: dict[str, DataFrame] | None = None,
    meet: bool = False,
) -> DataFrame:
    """`df` with `_cell_weight` (tokens in the target mix per token held), `_keep_probability` and `_kept`.

    `by` names the attributes whose marginals are raked: token counts per cell
    meet the targets (given, or `tempered` by default) of all attributes at once.
    A document is kept with a probability in proportion to its cell's weight, 1 at
    most, at the rate that gives `budget` of all tokens in expectation. A cell that
    would need more than it holds keeps all of its documents; none repeats, and the sample falls short of the targets there.
    With `meet` the sample meets the targets in expectation and `budget` is only an
    upper limit: no probability is cut at 1. NULL attributes are a value of their own, `unknown`. A
    text without words weighs nothing and is kept with the probability of its
    cell. Rows with the same id are kept or left together; a NULL id is drawn as empty
    text. Columns named like the outputs are replaced.
    """
    names = [f"_by_{n}" for n in by]
    df = df.drop("_cell_weight", "_keep_probability", "_kept", "__mix_p", "__mix_factor")
    labelled = df.withColumns({a: F.coalesce(c.cast("string"), F.lit("unknown")) for a, c in zip(names, by.values(), strict=True)})
    cells = write_table(
        labelled.groupBy(*names).agg(F.sum(words_in(F.col(text))).alias("_tokens")), "mixing-cells"
    )
    targets = targets or {a: write_table(tempered(cells, a, "_tokens", power), "mixing-targets") for a in names}
    total = cells.agg(F.sum("_tokens")).first()[0] or 0
    if meet and total:
        raked = rake_within(cells, names, "_tokens", targets, total, budget)
    else:
        raked = rake(cells, names, "_tokens", targets, sweeps)
    # tokens in the target mix per token held
    factors = raked.withColumn("__mix_factor", F.when(F.col("_tokens") > 0, F.col("weight") * float(total) / F.col("_tokens")))
    rate = budget
    if meet:
        rate = min(budget, 1 / (factors.agg(F.max("__mix_factor")).first()[0] or 1.0))
    for _ in range(0 if meet else RATE_STEPS):
        held = factors.agg(F.sum(F.col("_tokens") * F.least(F.lit(1.0), F.col("__mix_factor") * rate))).first()[0]
        rate = rate * budget * total / held if held else rate
    factors = write_table(factors.select(*names, "__mix_factor", F.least(F.lit(1.0), F.col("__mix_factor") * rate).alias("__mix_p")), "mixing-factors")
    return (
        labelled.join(factors, names, "left")
        .withColumn("_cell_weight", F.coalesce("__mix_factor", F.lit(0.0)))
        .withColumn("_keep_probability", F.coalesce("__mix_p", F.lit(1.0)))
        .withColumn("_kept", uniform(F.col(doc_id), seed) < F.col("_keep_probability"))
        .drop("__mix_factor", "__mix_p")
    )


def oracle(by: dict[str, str], tokens: str, power: float = TEMPERATURE, sweeps: int = SWEEPS, budget: float = BUDGET, seed: int = 17) -> str:
    """The same in SQL: one common table per sweep and attribute. `by` and `tokens` are SQL over `documents`."""
    names = list(by)
    keys = ", ".join(names)
    steps = [
        "labelled AS MATERIALIZED (SELECT doc_id, "
        + ", ".join(f"coalesce({sql}, 'unknown') AS {n}" for n, sql in by.items())
        + f", {tokens} AS tokens FROM documents)",
        f"w0 AS MATERIALIZED (SELECT {keys}, sum(tokens) AS tokens, CAST(sum(tokens) AS DOUBLE) AS w FROM labelled GROUP BY ALL)",
    ]
    for n in names:
        steps.append(f"share_{n} AS (SELECT {n}, pow(sum(tokens), {power}) AS t FROM w0 GROUP BY {n} HAVING sum(tokens) > 0)")
        steps.append(f"target_{n} AS MATERIALIZED (SELECT {n}, t / sum(t) OVER () AS target FROM share_{n})")
    k = 0
    for _ in range(sweeps):
        for n in names:
            steps.append(
                f"w{k + 1} AS MATERIALIZED (SELECT w.* REPLACE (coalesce(w.w * t.target / s.total, 0.0) AS w) FROM w{k} w "
                f"LEFT JOIN (SELECT {n}, sum(w) AS total FROM w{k} GROUP BY {n}) s USING ({n}) LEFT JOIN target_{n} t USING ({n}))"
            )
            k += 1
    steps.append("total AS MATERIALIZED (SELECT sum(tokens) AS t FROM w0)")
    steps.append(f"factor AS MATERIALIZED (SELECT {keys}, tokens, w * (SELECT t FROM total) / nullif(tokens, 0) AS f FROM w{k})")
    steps.append(f"rate0 AS (SELECT CAST({budget} AS DOUBLE) AS rate)")
    for step in range(RATE_STEPS):
        rate = f"(SELECT rate FROM rate{step})"
        steps.append(
            f"rate{step + 1} AS MATERIALIZED (SELECT {rate} * {budget} * (SELECT t FROM total) / sum(tokens * least(1.0, f * {rate})) AS rate FROM factor)"
        )
    steps.append(f"p AS (SELECT {keys}, coalesce(least(1.0, f * (SELECT rate FROM rate{RATE_STEPS})), 1.0) AS p FROM factor)")
    draw = f"CAST('0x' || substr(md5('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) / {float(16**12)!r}"
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, {keys}, round(p, 8) AS keep_probability, {draw} < p AS kept "
        f"FROM labelled JOIN p USING ({keys})"
    )


def topic_sql(text: str = "text") -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({text}, {mark!r})' for mark in marks)} THEN '{name}'" for name, marks in TOPICS)
    return f"CASE {cases} ELSE 'prose' END"


def words_sql(text: str = "text") -> str:
    return f"coalesce(len(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')), 0)"
