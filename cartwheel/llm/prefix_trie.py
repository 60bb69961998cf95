"""The trie of conversation openings: which turns conversations share, and what sharing them saves.

Conversations are cut into blocks of a few turns, and blocks are sorted, so that
those with a common opening are neighbours. Each batch of sorted blocks becomes a
forest by uniting neighbours from the longest common prefix down: every
union makes a branching node. A node that does not touch its batch's ends, and below
which no conversation goes on in a further block, is complete. The others are
contracted to one row each, and rows of one node are merged over all batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.skew import SLICE, range_slices, running
from cartwheel.scratch import write_table

# turns in one block: bounds the rows that are sorted, whatever a conversation's length
BLOCK = 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_FIELDS = {
    "open": (T.BooleanType(), pa.bool_()),
    "key": (T.StringType(), pa.string()),
    "parent_key": (T.StringType(), pa.string()),
    "conv_id": (T.LongType(), pa.int64()),
    "parent_conv_id": (T.LongType(), pa.int64()),
    "depth": (T.LongType(), pa.int64()),
    "n_convs": (T.LongType(), pa.int64()),
    "n_children": (T.LongType(), pa.int64()),
    "n_leaves": (T.LongType(), pa.int64()),
    "weight": (T.LongType(), pa.int64()),
    "n_ends": (T.LongType(), pa.int64()),
    "ends": (T.StringType(), pa.string()),
    "first_end": (T.LongType(), pa.int64()),
    "bytes": (T.LongType(), pa.int64()),
    "bytes_before": (T.LongType(), pa.int64()),
    "path": (T.ArrayType(T.StringType()), pa.list_(pa.string())),
}
_SCHEMA = T.StructType([T.StructField(n, t) for n, (t, _) in _FIELDS.items()])
_MASK = (1 << 64) - 1


def numbered_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, turn, size): the turns of each conversation from 1, a 128-bit hash of role and text, and the text's bytes.

    In the order of `turn`, NULL first; of rows with one number the smaller hash comes first. A NULL role or
    text is an empty one; rows without a conversation are left out. A conversation of any length is numbered in slices.
    """
    said, words = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("at"),
        F.unhex(F.md5(F.concat(F.octet_length(said), F.lit(":"), said, words))).alias("turn"),
        F.octet_length(words).cast("long").alias("size"),
    )
    slices = range_slices(rows, ["conv"], ["at", "turn"], "trie-rows")
    return write_table(running(slices, ["conv"], ["at", "turn"], sums={"place": F.lit(1)}).select("conv", "place", "turn", "size"), "trie-turns")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv").agg(F.max("place").alias("length"))


def with_shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) in which every conversation c opens like c - c % 5, for crc32(c) % 9 turns, and goes on with its own after as many."""
    convs = lengths(turns)
    cut = F.crc32(F.col("conv").cast("string")) % 9
    opened = convs.select("conv", (F.col("conv") - F.col("conv") % 5).alias("model"), cut.alias("cut"), "length")
    models = convs.select(F.col("conv").alias("model"), F.col("length").alias("there"))
    plan = write_table(
        opened.join(models, "model", "left").select(
            "conv", "model", "cut", F.least("cut", F.coalesce("there", F.lit(0))).alias("taken"), F.greatest(F.col("length") - F.col("cut"), F.lit(0)).alias("own")
        ),
        "trie-openings",
    )
    own = turns.join(plan.filter("own > 0").select("conv", "cut", "taken"), "conv").filter("place > cut")
    own = own.select("conv", (F.col("taken") + F.col("place") - F.col("cut")).alias("place"), "turn", "size")
    openings = turns.filter("place <= 8").withColumnRenamed("conv", "model").join(plan.filter("taken > 0").select("conv", "model", "taken"), "model")
    openings = openings.filter("place <= taken").select("conv", "place", "turn", "size")
    return plan.select("conv", (F.col("taken") + F.col("own")).alias("length")), own.unionByName(openings)


def blocks_of(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, block, length, turns, and the key and bytes of all turns before) of each stretch of `block` turns; one empty one for a conversation without turns.

    A prefix's key is the exclusive or of hashes of its turns with their places,
    so that it can be totalled in any order. It has 128 bits.
    """
    kept = turns.withColumns({"x": F.xxhash64("place", "turn"), "y": F.xxhash64("turn", "place", F.lit(11)), "block": F.floor((F.col("place") - 1) / block)})
    stretches = kept.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "turn", "size", "x", "y"))).alias("turns"),
        F.bit_xor("x").alias("x"),
        F.bit_xor("y").alias("y"),
        F.sum("size").alias("size"),
    )
    empty = convs.filter("length = 0").select("conv", F.lit(0).cast("long").alias("block"))
    stretches = stretches.join(convs, "conv").unionByName(
        empty.withColumns({"turns": F.array().cast(stretches.schema["turns"].dataType), "x": F.lit(0).cast("long"), "y": F.lit(0).cast("long"), "size": F.lit(0).cast("long"), "length": F.lit(0).cast("long")})
    )
    slices = range_slices(stretches, ["conv"], ["block"], "trie-blocks")
    totals = running(slices, ["conv"], ["block"], sums={"upto": F.col("size")}, xors={"xs": F.col("x"), "ys": F.col("y")})
    return write_table(
        totals.select(
            "conv",
            "block",
            "length",
            F.col("xs").bitwiseXOR(F.col("x")).alias("x"),
            F.col("ys").bitwiseXOR(F.col("y")).alias("y"),
            (F.col("upto") - F.col("size")).alias("before"),
            F.transform("turns", lambda t: t["turn"]).alias("turns"),
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
            F.transform("turns", lambda t: t["x"]).alias("xs"),
            F.transform("turns", lambda t: t["y"]).alias("ys"),
        ),
        "trie-prefixes",
    )


def _key(x: int, y: int) -> str:
    return f"{x & _MASK:016X}{y & _MASK:016X}"


class Part:
    """A class of neighbouring blocks, as the node of their common prefix of `depth` turns."""

    __slots__ = ("lo", "hi", "depth", "n", "least", "children", "ends", "weight", "leaves", "goes_on", "waiting")

    def __init__(self, row: int, depth: int, conv: int, goes_on: bool) -> None:
        self.lo = self.hi = row
        self.depth, self.n, self.least, self.goes_on = depth, 1, conv, goes_on
        self.ends = [] if goes_on else [conv]
        self.children = self.weight = self.leaves = 0
        self.waiting: list[int] = []  # rows of children, for which this node's smallest member is not known yet

    def take(self, other: Part) -> None:
        """Unite with the class to the right, at equal depth."""
        self.hi, self.n, self.least = other.hi, self.n + other.n, min(self.least, other.least)
        self.children += other.children
        self.weight += other.weight
        self.leaves += other.leaves
        self.goes_on |= other.goes_on
        self.ends += other.ends
        self.waiting += other.waiting


class Forest:
    """The nodes of one batch of sorted blocks."""

    def __init__(self, blocks: list[dict], block: int) -> None:
        self.blocks, self.block, self.rows = blocks, block, {n: [] for n in _FIELDS}
        self.keys, self.bytes = [], []
        for b in blocks:
            x, y, size = b["x"], b["y"], b["before"]
            keys, sizes = [_key(x, y)], [size]
            for dx, dy, s in zip(b["xs"], b["ys"], b["sizes"], strict=True):
                x, y, size = x ^ dx, y ^ dy, size + s
                keys.append(_key(x, y))
                sizes.append(size)
            self.keys.append(keys)
            self.bytes.append(sizes)

    def shared(self, i: int) -> int:
        """Turns that block i shares with the one before it; -1 if what precedes them differs."""
        a, b = self.blocks[i - 1], self.blocks[i]
        if self.keys[i - 1][0] != self.keys[i][0] or a["block"] != b["block"]:
            return -1
        n = 0
        for s, t in zip(a["turns"], b["turns"], strict=False):
            if s != t:
                break
            n += 1
        return n

    def emit(self, **values) -> int:
        for name, column in self.rows.items():
            column.append(values.get(name))
        return len(self.rows["open"]) - 1

    def leave(self, part: Part) -> None:
        """Write the node of `part` and step to the prefix one turn shorter."""
        d, at = part.depth, part.lo
        here, before = self.bytes[at][d], self.bytes[at][d - 1] if d else 0
        depth = self.blocks[at]["block"] * self.block + d
        if d and part.lo and part.hi < len(self.blocks) - 1 and not part.goes_on:
            weight = part.weight + (part.children + len(part.ends) - 1) * here
            leaves = part.leaves if part.children else 1
            row = self.emit(
                open=False, conv_id=part.least, depth=depth, n_convs=part.n, n_children=part.children, n_leaves=leaves,
                weight=weight - (part.n - 1) * before, ends=hashlib.sha256(",".join(map(str, part.ends)).encode()).hexdigest() if part.ends else _EMPTY,
            )
            for child in part.waiting:
                self.rows["parent_conv_id"][child] = part.least
            part.children, part.weight, part.leaves, part.waiting = 1, weight, leaves, [row]
        else:
            # at the head of a later block stands a node that its members' earlier blocks count
            counted = d or not depth
            self.emit(
                open=True, key=self.keys[at][d], parent_key=self.keys[at][d - 1] if d else None, conv_id=part.least if counted else None, depth=depth,
                n_convs=part.n if counted else 0, n_children=part.children, n_leaves=part.leaves, weight=part.weight, n_ends=len(part.ends),
                ends=",".join(map(str, part.ends)) if part.ends else None, first_end=part.ends[0] if part.ends else None,
                bytes=here, bytes_before=before, path=self.keys[at][: d + 1],
            )
            for child in part.waiting:
                self.rows["parent_key"][child] = self.keys[at][d]
            part.children, part.weight, part.leaves, part.waiting = 0, 0, 0, []
        part.ends, part.depth = [], d - 1

    def grow(self) -> dict[str, list]:
        shared = [-1, *[self.shared(i) for i in range(1, len(self.blocks))]]
        parts = {}
        for i, b in enumerate(self.blocks):
            n = len(b["turns"])
            parts[i] = Part(i, n, b["conv"], b["block"] * self.block + n < b["length"])
        up = list(range(len(self.blocks)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i in sorted((i for i, s in enumerate(shared) if s >= 0), key=lambda i: -shared[i]):
            a, b = find(i - 1), find(i)
            left, right = parts.pop(a), parts.pop(b)
            for part in (left, right):
                while part.depth > shared[i]:
                    self.leave(part)
            root, other = (a, b) if left.n >= right.n else (b, a)
            left.take(right)
            up[other], parts[root] = root, left
        for part in parts.values():
            while part.depth >= 0:
                self.leave(part)
        return self.rows


def _forests(block: int):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Forest(batch.to_pylist(), block).grow()
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, (_, t) in _FIELDS.items()], names=list(_FIELDS))

    return grow


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over its pieces in order; only the running state is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_pydict({"key": [k for k, _ in done], "sha": [s for _, s in done]}, pa.schema([("key", pa.string()), ("sha", pa.string())]))
    if state is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "sha": [state.hexdigest()]})


def _merged(nodes: DataFrame) -> DataFrame:
    """Contracted nodes: the rows of one node from all batches, its open children counted once."""
    rows = nodes.filter("open").groupBy("key").agg(
        F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_children").alias("closed"),
        F.sum("n_ends").alias("n_ends"),
        F.sum("weight").alias("weight"),
        F.sum("n_leaves").alias("leaves"),
        F.max("bytes").alias("bytes"),
        F.max("bytes_before").alias("bytes_before"),
        F.max("parent_key").alias("parent_key"),
        F.max(F.struct(F.size("path").alias("n"), "path"))["path"].alias("path"),
    )
    rows = write_table(rows, "trie-open")
    children = rows.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    rows = rows.join(children, "key", "left").withColumn("n_children", F.col("closed") + F.coalesce("more", F.lit(0)))
    return write_table(
        rows.withColumns(
            {
                # of k parts that meet at a node, k - 1 save all that lies before its end
                "weight": F.col("weight") + (F.col("n_children") + F.col("n_ends") - 1) * F.col("bytes"),
                "leaves": F.col("leaves") + (F.col("n_children") == 0).cast("long"),
            }
        ).drop("closed", "more", "bytes"),
        "trie-merged",
    )


def _totals(merged: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """(key, weight, leaves): each contracted node's own sums and those of all contracted nodes below it.

    A node passes its sums to the nodes on its path within the block, and
    along its smallest member's earlier blocks to those before. Only nodes at which something
    branches or ends have any, so that there are no more rows than turns.
    """
    given = merged.filter("weight <> 0 OR leaves <> 0").withColumn("at", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / block))
    near = given.select(F.explode("path").alias("key"), "weight", "leaves")

    def along(start: str, turns: str) -> str:
        return f"transform({turns}, (t, j) -> lpad(hex(aggregate(slice({turns}, 1, j), {start}, (s, v) -> s ^ v)), 16, '0'))"

    earlier = blocks.filter(F.col("length") > block).select(
        "conv", "block", F.expr(f"zip_with({along('x', 'xs')}, {along('y', 'ys')}, (a, b) -> concat(a, b))").alias("keys")
    )
    deep = given.filter("at > 0").select(F.col("conv_id").alias("conv"), "at", "weight", "leaves")
    far = deep.join(earlier, "conv").filter("block < at").select(F.explode("keys").alias("key"), "weight", "leaves")
    return near.unionByName(far).groupBy("key").agg(F.sum("weight").alias("weight"), F.sum("leaves").alias("n_leaves"))


def trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per distinct opening of the conversations (conv, length), whose turns are (conv, place, turn, size).

    conv_id (smallest member), depth, parent_conv_id (the parent's smallest member; NULL for
    the root), n_convs (members), n_children, n_leaves (nodes without children
    in the subtree), saved_tokens (bytes that members share, over the subtree), ends_sha256 (of the ids of members that
    end here). No conversations give no rows; those without turns are members of the root.

    A conversation or a group of copies may hold any share of the rows: blocks are
    range-partitioned with the id as the last key, and each batch of them is a forest of its
    own. Only an ends_sha256 is made by one task from all of its ids, as a hash has to be:
    they come joined, a batch's ids at a time, and are not held.
    """
    blocks = blocks_of(convs, turns, block)
    order = ["block", "x", "y", "turns", "conv"]
    nodes = write_table(blocks.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_forests(block), _SCHEMA), "trie-nodes")
    merged = _merged(nodes)
    totals = _totals(merged, blocks, block)
    pieces = nodes.filter("open AND ends IS NOT NULL").select("key", "first_end", "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "first_end").mapInArrow(_digests, "key string, sha string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    opened = (
        merged.drop("weight", "path", "leaves")
        .join(totals, "key")
        .join(digests, "key", "left")
        .join(parents, "parent_key", "left")
        .withColumn("saved_tokens", F.col("weight") - (F.col("n_convs") - 1) * F.col("bytes_before"))
        .withColumn("ends_sha256", F.coalesce("sha", F.lit(_EMPTY)))
    )
    closed = nodes.filter("NOT open").withColumns({"saved_tokens": F.col("weight"), "ends_sha256": F.col("ends")})
    below = closed.filter("parent_conv_id IS NULL").drop("parent_conv_id").join(parents, "parent_key")
    return opened.select(*columns).unionByName(below.select(*columns)).unionByName(closed.filter("parent_conv_id IS NOT NULL").select(*columns))


def prefix_trie(df: DataFrame, conv_id: str, turn: str, role: str, text: str, block: int = BLOCK) -> DataFrame:
    """The trie of the conversations in `df`, as `trie` returns it; rows and order as in `numbered_turns`."""
    turns = numbered_turns(df, conv_id, turn, role, text)
    return trie(lengths(turns), turns, block)
