"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# chunks, and pre-tokens, in each of the two generations that one worker remembers
REMEMBERED = 220_000


# a word of the lower bitmap level holds 2 ** WORD ranks; Python integers are as wide as they need to be
WORD = 8
MASK = (1 << WORD) - 1
# characters of text whose new pre-tokens share one queue
TOGETHER = 1_000_000


class Recent(dict):
    """Texts and their ids in two generations: what has not been asked for while one filled up is forgotten."""

    def __init__(self) -> None:
        self.older: dict[str, bytes] = {}

    def among(self, texts: set[str]) -> dict[str, bytes]:
        """Those of the texts that are remembered, with their ids."""
        found = {t: self[t] for t in texts if t in self}
        again = {t: self.older[t] for t in texts if t in self.older and t not in found}
        self.keep(again)
        return found | again

    def keep(self, found: dict[str, bytes]) -> None:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self.update(found)


class Codec:
    """Encodes and decodes with one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.low = [0] * ((max(self.tokens, default=0) >> WORD) + 1)
        self.pattern = regex.compile(pattern)
        self.pieces, self.chunks = Recent(), Recent()
        self.byte_ids = np.array([ranks.get(bytes([x]), -1) for x in range(256)])
        self.byte_pairs = np.array([ranks.get(bytes([x, y]), -1) for x in range(256) for y in range(256)])

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token; all of them share one queue, and no merge crosses their ends.

        Parts are a linked list over the joined bytes. Each merge rank in use has a
        bucket of positions and a bit in a two-level bitmap: `low` has a bit per
        rank, `top` one per word of `low`. The next rank is found by one
        find-first-set per level; entries whose pair has changed are skipped.
        Ranks leave in order, and equal ones from left to right, as they would in
        each pre-token alone.
        """
        text = b"".join(pieces)
        n = len(text)
        if not n:
            return [b""] * len(pieces)
        get, low, top = self.ranks.get, self.low, 0
        cuts = np.cumsum([len(x) for x in pieces])
        edge = bytearray(n + 1)  # 1 where a pre-token begins or the text ends
        edge[0] = 1
        for cut in cuts.tolist():
            edge[cut] = 1
        raw = np.frombuffer(text, np.uint8).astype(np.int64)
        first = np.full(n, -1)
        first[:-1] = self.byte_pairs[raw[:-1] * 256 + raw[1:]]
        first[cuts - 1] = -1
        pair = first.tolist()  # rank of the pair that starts here; a bucket entry that says otherwise is stale
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        part, alive = self.byte_ids[raw].tolist(), bytearray(b"\x01" * n)
        buckets: dict[int, list[int]] = {}
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranked = first[order]
        starts = np.flatnonzero(np.diff(ranked, prepend=-1))
        for rank, positions in zip(ranked[starts].tolist(), np.split(order, starts[1:]), strict=True) if len(order) else ():
            buckets[rank] = positions.tolist()
            low[rank >> WORD] |= 1 << (rank & MASK)
            top |= 1 << (rank >> WORD)
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            lowest = (word << WORD) + (bits & -bits).bit_length() - 1
            bits = low[word] = bits & (bits - 1)
            if not bits:
                top &= top - 1
            bucket = buckets.pop(lowest)
            if len(bucket) > 1:
                bucket.sort()
            for at, i in enumerate(bucket):
                if pair[i] != lowest:
                    continue
                j = after[i]
                end = after[i] = after[j]
                pair[j], alive[j], part[i] = -1, 0, lowest
                lower = False
                if edge[end]:
                    pair[i] = -1
                    if end < n:
                        before[end] = i
                else:
                    before[end] = i
                    rank = get(text[i : after[end]])
                    if rank is None:
                        pair[i] = -1
                    else:
                        pair[i] = rank
                        if rank in buckets:
                            buckets[rank].append(i)
                        else:
                            buckets[rank] = [i]
                            low[rank >> WORD] |= 1 << (rank & MASK)
                            top |= 1 << (rank >> WORD)
                        lower = rank < lowest
                if not edge[i]:
                    left = before[i]
                    rank = get(text[left:end])
                    if rank is None:
                        pair[left] = -1
                    else:
                        pair[left] = rank
                        if rank in buckets:
                            buckets[rank].append(left)
                        else:
                            buckets[rank] = [left]
                            low[rank >> WORD] |= 1 << (rank & MASK)
                            top |= 1 << (rank >> WORD)
                        lower = lower or rank < lowest
                if lower and at + 1 < len(bucket):  # a lower rank goes first; the rest of this bucket waits
                    buckets[lowest] = bucket[at + 1 :]
                    low[lowest >> WORD] |= 1 << (lowest & MASK)
                    top |= 1 << (lowest >> WORD)
                    break
        alive_at = np.flatnonzero(np.frombuffer(alive, np.uint8))
        packed = np.array(part)[alive_at].astype("<u4").tobytes()
        ends = (np.searchsorted(alive_at, cuts) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _pieces(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: remembered, whole tokens, or merged together."""
        found = self.pieces.among(wanted)
        new = [x for x in wanted if x not in found]
        raw = [x.encode("utf-8", "surrogatepass") for x in new]
        ranks = [self.ranks.get(x) for x in raw]
        made = {x: pack("<I", rank) for x, rank in zip(new, ranks, strict=True) if rank is not None}
        rest = [k for k, rank in enumerate(ranks) if rank is None]
        made.update(zip([new[k] for k in rest], self.merge([raw[k] for k in rest]), strict=True))
        self.pieces.keep({x: ids for x, ids in made.items() if len(x) <= 64})
        return found | made

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers.

        A single space between two visible characters always starts a
        pre-token, so a text may be cut there and the parts looked up. Parts
        next to other white space stay together.
        """
        done: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            if text[:1] == " " or text[-1:] == " " or "\0" in text or any(x in text for x in LOOSE):
                group.append(CUT.split(text))
            else:
                group.append(text.replace(" ", "\0 ").split("\0"))
            size += len(text)
            if size >= TOGETHER:
                done += self._encode(group)
                group, size = [], 0
        return done + self._encode(group)

    def _encode(self, group: list[list[str]]) -> list[bytes]:
        wanted = set().union(*group)
        found = self.chunks.among(wanted)
        new = {chunk: self.pattern.findall(chunk) for chunk in wanted if chunk not in found}
        ids = self._pieces(set().union(*new.values()))
        made = {chunk: ids[x[0]] if len(x) == 1 else b"".join([ids[y] for y in x]) for chunk, x in new.items()}
        self.chunks.keep({chunk: packed for chunk, packed in made.items() if len(chunk) <= 64})
        found |= made
        return [b"".join([found[part] for part in parts]) for parts in group]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


# white space with a space before or after it, and the places before spaces that stand alone
LOOSE = [x for c in map(chr, range(0x3001)) if c.isspace() for x in dict.fromkeys((f" {c}", f"{c} "))]
CUT = re.compile(r"(?<=\S)(?= \S)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and rank file."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def _with(df: DataFrame, fields: list[T.StructField], drop: set[str]) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in drop] + fields)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that a worker holds few texts and ids."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield batch.slice(start, 500)


def encode_texts(df: DataFrame, text: str, path: str, pattern: str, ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """`df` without `text`, with its token ids packed as little-endian unsigned 32-bit integers, and their number.

    `path` is a rank file that every worker can read; it holds a public
    vocabulary, never a copy made here. A NULL or empty text has no ids. Long
    texts are encoded whole: a pre-token of n bytes takes at most n merges, each
    found by three find-first-set steps. Columns of `df` named like the two
    outputs are replaced; repeated rows are encoded each on their own.
    """
    df = df.drop(*({ids, count} - {text}))
    kept = [c for c in df.columns if c != text]
    schema = _with(df, [T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType())], {text})

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = codec(path, pattern)
        for batch in _small(batches):
            packed = used.encode([value.as_py() or "" for value in batch.column(text)])
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(packed, pa.binary()), pa.array([len(x) // 4 for x in packed], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, count])

    return df.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(encoded, schema)


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the bytes that the packed `ids` stand for. NULL ids decode to no bytes; a column named like the output is replaced."""
    df = df.drop(decoded)
    names = df.columns
    schema = _with(df, [T.StructField(decoded, T.BinaryType())], set())

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = codec(path, pattern)
        for batch in _small(batches):
            texts = [used.decode(value.as_py() or b"") for value in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*names, decoded])

    return df.mapInArrow(restored, schema)
