"""Similar documents by a grouped prefix join on word shingles.

A document's set of shingles is sorted by hash; two sets of Jaccard similarity t or
more share a member among their first n - ceil(t n) + 1. Documents with equal
sets are one class. Classes that share a prefix member are candidates where their
sizes and the sketches of their sets allow the similarity; only those are compared.
Long sets fill a sketch of fixed size, so candidates are tested again by sketches that
grow with the sets, before any set is sent to meet another.

Two things keep common passages and large groups of near copies from pairing all
with all. Shingles that very many classes hold in their prefixes come last in the
order, so that a prefix is made of rarer ones where there are any. And each class is
first compared with the least and the greatest class of every list that it stands
in; after that, members of one component need no comparison any more, since all that
is asked for is who is connected. What is left meets list by list, where sketches
tell pairs apart in the join itself: it makes rows of very similar texts only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import components
from cartwheel.scratch import drop_table, write_table

# a shingle in more prefixes than this comes last in the order of all shingles
HOT = 40
# bits that tell which texts have to be read again
BITMAP = 1 << 22
# bits of the sketch of a set, and its columns
SKETCH = 1024
SKETCH_COLUMNS = [f"s{k}" for k in range(SKETCH // 64)]
# words whose hashes one worker remembers, and texts whose sets it holds at a time
REMEMBERED, TOGETHER = 150_000, 1_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


def shingle_set(text: str | None, words: int, known: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of `words` words in a row, A-Z in lower case, split at ASCII white space.

    A text with fewer words has one shingle, all of them; one without words none.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    mixed = np.full(len(tokens) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + len(mixed)]) * _A
        mixed ^= mixed >> np.uint64(32)
        mixed *= _B
    return np.unique(mixed.view(np.int64))


def _class_of(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _sketch(members: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """A bit for each member, `bits` bits in all: two sketches never differ in more bits than their sets differ in members."""
    # parities: members that both hold cancel out
    return np.packbits((np.bincount(members & (bits - 1), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def _wide_sketch(members: np.ndarray) -> np.ndarray:
    """A sketch of two to four bits a member, SKETCH at least, a power of two."""
    return _sketch(members, max(SKETCH, 1 << (2 * len(members) - 1).bit_length()))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a bounded number of texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(start, TOGETHER)


def _summaries(words: int, percent: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in _parts(batches):
            sizes, classes, sketches, prefixes = [], [], [], []
            for value in batch.column("text"):
                members = shingle_set(value.as_py(), words, known)
                sizes.append(len(members))
                classes.append(_class_of(members))
                sketches.append(_sketch(members))
                # the prefix and half as much: what comes in for shingles that move to the end of the order
                prefixes.append(members[: _prefix_length(len(members), percent) * 3 // 2] if len(members) else members)
            lists = (pa.array(x, pa.list_(pa.int64())) for x in (sketches, prefixes))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "cls", "sketch", "front"])

    return summarise


def _bitmap(ids: DataFrame) -> np.ndarray:
    """BITMAP bits that tell which ids may be among the given ones; of this size whatever their number."""
    slot = F.pmod(F.xxhash64("id"), F.lit(BITMAP))
    words = ids.select(F.floor(slot / 32).alias("word"), F.expr("shiftleft(1L, int(pmod(pmod(xxhash64(id), %d), 32)))" % BITMAP).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITMAP // 32, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def _sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(cls, members, wide) of the documents with the given ids, and of a few others; texts are not shuffled for it."""
    wanted = _bitmap(ids)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in _parts(batches):
            slots = batch.column("slot").to_numpy(zero_copy_only=False)
            sets = [
                shingle_set(batch.column("text")[k].as_py(), words, known)
                for k in np.flatnonzero(wanted[slots >> 5] >> (slots & 31) & 1).tolist()
            ]
            lists = (pa.array(x, pa.list_(pa.int64())) for x in (sets, [_wide_sketch(x) for x in sets]))
            yield pa.RecordBatch.from_arrays([pa.array([_class_of(x) for x in sets], pa.int64()), *lists], names=["cls", "members", "wide"])

    rows = docs.filter("doc_id IS NOT NULL").select(F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP)).alias("slot"), "text")
    return rows.mapInArrow(build, "cls long, members array<long>, wide array<long>")


def _prefixed(rows: DataFrame, prefix: str, but: tuple[str, ...] = ()) -> DataFrame:
    return rows.withColumnsRenamed({c: f"{prefix}_{c}" for c in rows.columns if c not in but})


def _may_link(percent: int) -> Column:
    """Whether sizes and sketches of `a` and `b` allow the similarity: most pairs end here, without their sets.

    Sets that link differ in at most (100 - p) / (100 + p) of the sum of their sizes.
    """
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH_COLUMNS[1:]), F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))))
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    return sizes & (apart * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent))


def _folded(wide: Column, width: Column) -> Column:
    """The sketch of the same set in `width` words, a power of two that is not above its own."""
    words = F.transform(
        F.sequence(F.lit(1), width),
        lambda k: F.aggregate(F.sequence(k, F.size(wide), width), F.lit(0).cast("long"), lambda x, at: x.bitwiseXOR(F.element_at(wide, at))),
    )
    return F.when(F.size(wide) == width, wide).otherwise(words)


def _still_may_link(percent: int) -> Column:
    """`_may_link` by the wide sketches `a` and `b` of sets of `n_a` and `n_b` members."""
    width = F.least(F.size("a"), F.size("b"))
    apart = F.zip_with(_folded(F.col("a"), width), _folded(F.col("b"), width), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(apart, F.lit(0).cast("long"), lambda total, bits: total + bits)
    return apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def _with_both(pairs: DataFrame, facts: DataFrame, column: str, *more: str) -> DataFrame:
    """Pairs (u, v) with `column` of u and v as `a` and `b`, and `more` as `_a` and `_b`."""
    for end, side in (("u", "a"), ("v", "b")):
        pairs = pairs.join(facts.select(F.col("cls").alias(end), F.col(column).alias(side), *[F.col(c).alias(f"{c}_{side}") for c in more]), end)
    return pairs


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose sets are similar enough. `pairs` is a scratch table, and gone afterwards."""
    asked = pairs.select(F.col("u").alias("cls")).union(pairs.select("v")).distinct()
    sets = _sets_of(docs, classes.join(asked, "cls").select(F.col("low").alias("id")), words).dropDuplicates(["cls"])
    sets = write_table(sets.withColumn("n", F.size("members").cast("long")), "shingle-sets")
    close = write_table(_with_both(pairs, sets, "wide", "n").filter(_still_may_link(percent)).select("u", "v"), "shingle-close")
    both = _with_both(close, sets, "members").withColumn("shared", F.size(F.array_intersect("a", "b")))
    links = both.filter(F.col("shared") * 100 >= (F.size("a") + F.size("b") - F.col("shared")) * percent)
    links = write_table(links.select("u", "v"), "shingle-links")
    drop_table(pairs, sets, close)
    return links


def similar_documents(df: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `df`.

    Two documents link when intersection over union of their shingle sets is
    `percent` / 100 or more; `component_id` is the smallest id reachable. A NULL or
    empty text, or one without words, links with nothing. Repeated rows are
    documents with equal sets. A row with a NULL id takes no part and gets a NULL
    component. An empty table gives no rows.
    """
    return similar_classes(df, doc_id, text, words, percent).drop("cls")


def with_class(df: DataFrame, text: str, words: int) -> DataFrame:
    """`df` with `_cls`, which tells equal shingle sets, as `cls` in `similar_classes` does."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            found = [_class_of(shingle_set(value.as_py(), words, known)) for value in batch.column(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "_cls"])

    return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField("_cls", T.LongType())]))


def similar_classes(df: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """`similar_documents` with `cls`, the same for rows with equal shingle sets."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n long, cls long, sketch array<long>, front array<long>"
    fronts = write_table(docs.mapInArrow(_summaries(words, percent), schema), "shingle-rows")
    length = (F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1).cast("int")
    # equal sets are one class: the large part of a group of copies ends here
    leaders = write_table(
        fronts.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("front").alias("front")),
        "shingle-leaders",
    )
    # fronts are long: only postings are made of them
    rows = write_table(fronts.select("doc_id", "n", "cls"), "shingle-sizes")
    sketch = [F.col("sketch")[k].alias(c) for k, c in enumerate(SKETCH_COLUMNS)]
    classes = write_table(leaders.select("cls", "low", "n", *sketch), "shingle-classes")
    drop_table(fronts)

    # ---- the order of shingles: those that many classes hold come last ----
    postings = write_table(leaders.select(F.col("cls").alias("unit"), "n", F.posexplode("front").alias("at", "token")), "shingle-postings")
    drop_table(leaders)
    counts = write_table(postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "shingle-counts")
    shared = postings.join(counts.select("token", (F.col("df") > HOT).cast("int").alias("late")), "token")
    # both follow from the size: no need to carry them along
    shared = shared.withColumn("length", length).withColumn("seen", F.least("n", F.floor(F.col("length") * 3 / 2)))
    so_far = Window.partitionBy("unit").orderBy("at")
    late_seen = F.sum("late").over(Window.partitionBy("unit"))
    placed = shared.select("unit", "n", "length", "seen", "at", "token", "late", F.sum("late").over(so_far).alias("before"), late_seen.alias("late_seen"))
    placed = write_table(placed, "shingle-placed")
    # those without enough other shingles among the ones seen so far need all of their shingles
    is_short = F.col("seen") - F.col("late_seen") < F.col("length")
    short = write_table(placed.filter(is_short).select(F.col("unit").alias("cls"), "length").distinct(), "shingle-short")
    short_sets = write_table(
        _sets_of(docs, classes.join(short.select("cls"), "cls").select(F.col("low").alias("id")), words).drop("wide").join(short, "cls"), "shingle-short-sets"
    )
    ordered = (
        short_sets.select("cls", "length", F.size("members").cast("long").alias("n"), F.explode("members").alias("token"))
        .join(counts.filter(F.col("df") > HOT).select("token", F.lit(1).alias("late")), "token", "left")
        .groupBy("cls", "n", "length")
        .agg(F.array_sort(F.collect_set(F.struct(F.coalesce("late", F.lit(0)).alias("late"), "token"))).alias("order"))
    )
    filled = ordered.select(F.col("cls").alias("unit"), "n", F.explode(F.slice("order", F.lit(1), F.col("length"))).alias("o"))
    filled = filled.select("unit", "n", "o.token")
    kept = placed.filter(~is_short & (F.col("late") == 0) & (F.col("at") - F.col("before") < F.col("length"))).select("unit", "n", "token")
    lists = write_table(kept.unionByName(filled), "shingle-lists")
    drop_table(short_sets)
    # a shingle of one front only is shared after all where a filled list took it from beyond its own front
    taken = lists.select("token").distinct().join(counts.select("token"), "token", "left_anti")
    lone = postings.join(taken, "token", "left_semi").join(short.select(F.col("cls").alias("unit")), "unit", "left_anti")
    lone = write_table(lone.select("unit", "n", "at", "token", F.lit(0).alias("late")), "shingle-lone")
    drop_table(postings, counts, short)
    ahead = placed.filter("late = 1").select("unit", "n", "at", "token", "late").join(lone.select("unit").distinct(), "unit", "left_semi")
    placed_lone = lone.unionByName(ahead).withColumns({"length": length, "pos": F.col("at") - F.sum("late").over(so_far)})
    placed_lone = placed_lone.filter((F.col("late") == 0) & (F.col("pos") < F.col("length"))).select("unit", "n", "token")
    placed_lone = write_table(placed_lone, "shingle-lone-lists")
    drop_table(placed, lone)
    every = lists.unionByName(placed_lone)
    place = F.struct("unit", "n")
    leads = every.groupBy("token").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter("least.unit <> most.unit")
    leads = write_table(leads, "shingle-leads")
    candidates = write_table(every.join(leads.select("token"), "token", "left_semi"), "shingle-shared")
    drop_table(lists, placed_lone)
    lists = candidates

    # ---- first, each class is compared with those that lead its lists ----
    facts = classes.drop("low").withColumnRenamed("cls", "unit")
    led = lists.join(leads, "token").select("unit", "n", F.explode(F.array("least", "most")).alias("lead")).filter("unit <> lead.unit")
    led = led.filter(F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * percent)
    led = led.select(F.greatest("unit", "lead.unit").alias("a_unit"), F.least("unit", "lead.unit").alias("b_unit")).distinct()
    close = led.join(_prefixed(facts, "a"), "a_unit").join(_prefixed(facts, "b"), "b_unit").filter(_may_link(percent))
    pairs = write_table(close.select(F.col("a_unit").alias("u"), F.col("b_unit").alias("v")), "shingle-pairs")
    links = _verified(pairs, docs, classes, words, percent)
    joined = write_table(components(links, "shingle-components"), "shingle-joined")

    # ---- then every candidate that is not connected yet ----
    side = lists.select("unit", "token").join(joined.withColumnRenamed("node", "unit"), "unit", "left")
    side = side.select("unit", "token", F.coalesce("component", "unit").alias("component"))
    # lists whose classes are all connected already need no pairs at all
    open_lists = side.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token")
    side = write_table(side.join(open_lists, "token", "left_semi").join(facts, "unit"), "shingle-open")
    drop_table(lists, leads, joined)
    apart = (F.col("a_unit") < F.col("b_unit")) & (F.col("a_component") != F.col("b_component"))
    met = _prefixed(side, "a", ("token",)).join(_prefixed(side, "b", ("token",)), "token").filter(apart & _may_link(percent))
    pairs = write_table(met.select(F.col("a_unit").alias("u"), F.col("b_unit").alias("v")).distinct(), "shingle-pairs")
    drop_table(side)
    links = links.unionByName(_verified(pairs, docs, classes, words, percent))
    found = write_table(components(links, "shingle-final"), "shingle-found")
    named = classes.select("cls", "low").join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "low", F.coalesce("component", "cls").alias("component"))
    lowest = write_table(named.groupBy("component").agg(F.min("low").alias("component_id")), "shingle-lowest")
    result = write_table(named.join(lowest, "component").select("cls", "component_id"), "shingle-result")
    drop_table(found, lowest, classes)
    takes_part = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.join(result, "cls", "left").select(
        "doc_id", "cls", F.col("n").alias("n_shingles"), F.when(takes_part, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
