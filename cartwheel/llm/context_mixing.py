"""Language-model scores by online logistic context mixing over the bits of words.

Frequent words of the training texts form a dictionary of bounded size, which
gives each a code of one to three bytes. Other words, and the end of a text where it is not
in there, are spelled between an escape byte and a space, frequent pairs of bytes as one. A text is
the bytes of its words in turn, coded bit by bit, most significant bit first.

Several predictors look at a bit through hashed contexts: the whole word so far, and that after
the last very frequent word and after the previous word, or, within a spelled word, the last
two bytes and the last one. Their counts come from all training texts. One more predictor looks at the
word so far among the words that the text itself has held. A gate chosen for each half of a byte by how many
contexts are known, and by how often the longest of them and the text's own were seen, holds the weights that mix the
predictions in the logistic domain, and a map refines the mixed probability. Weights and map
are learned online along the training texts, each part of which is predicted before it is counted.

Every text is then scored from there: weights and map go on adapting along it, from what went before alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.scratch import new_path, write_table

# slots of each predictor's table: the model keeps this size whatever it learns from
SLOT_BITS = 20
ORDERS = ("word", "after frequent", "after one")
# slots that tell what a text itself has held, the context that they are counted by, and coded bytes after which they age
OWN_BITS, OWN, AGING = 12, ORDERS.index("word"), 8192
# gates: how many contexts are known, how often the longest known one was seen, and how often the text's own
LEVELS = (2, 8, 64)
GATES = (len(ORDERS) + 1) * (len(LEVELS) + 1) * (len(LEVELS) + 2)
# steps of the refining map for each place in the trees of the halves of a byte
STEPS = 24
CELLS = 32 * STEPS
# words with a code of one, two and three bytes at most, and bytes that such a word may have
SHORT, MIDDLE, DICTIONARY, LONGEST = 128, 123 << 8, 1 << 18, 64
# characters of text whose words are counted together
BLOCK = 16_000_000
# training tokens that one task learns from, slots whose counts travel together
TOKENS_PER_TASK, TOGETHER = 4_000_000, 1 << 13
# coded bytes of a text that share one step of the online learning, early and at most, texts that advance side by side, and that are held at a time
WINDOW, WIDEST, SIDE_BY_SIDE, TEXTS = 32, 512, 64, 1024
# coded bytes of several texts that one step takes together
TAKEN = 4096
# bytes that no word holds, as UTF-8 has them not or they are white space or A-Z, and the words that tell what they spell
FREE, TELLING = bytes([*range(9, 14), *range(65, 91), 0xC0, 0xC1, *range(0xF5, 0xFF)]), 20_000
# rates of learning over all texts, where it takes so many bits for a full step, and along one, of its weights and of its map
RATE, DAMP, ALONG, FOLLOW = 1.0, 2500, 0.008, 1 / 60

# odd multipliers that spread contexts and halves of bytes over the slots
_NODE, _CONTEXT, _SLOT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# of each byte, by half and bit: its bits, and their places in the tree of the half
_BITS = ((np.arange(256) >> (7 - np.arange(8))[:, None]) & 1).astype(np.float32)
_PLACES = np.stack([1 << (k % 4) | ((np.arange(256) >> (4 if k < 4 else 0)) & 15) >> (4 - k % 4) for k in range(8)])
# counts of a slot hold the bits seen above, and the ones among them below
_ONE = 1 << 32
# a step of the looked-up predictions
_FINE = np.float32(9 / 127)


class Codes(dict):
    """Coded bytes of words: short codes of the given ones, in the order of their rank, and spelling for all others.

    Spelling puts single bytes for pairs, and for pairs of pairs, that are frequent in the rarest of the given words.
    """

    def __init__(self, words: list[bytes] = ()):
        super().__init__()
        words = words[:DICTIONARY]
        for rank, word in enumerate(words):
            if rank < SHORT:
                self[word] = bytes([rank])
            elif rank < SHORT + MIDDLE:
                self[word] = (rank - SHORT + (SHORT << 8)).to_bytes(2, "big")
            else:
                self[word] = (rank - SHORT - MIDDLE + (251 << 16)).to_bytes(3, "big")
        self.pairs: list[tuple[bytes, bytes]] = []
        text = b" ".join(words[-TELLING:])
        for free in FREE:
            x = np.frombuffer(text, np.uint8).astype(np.intp)
            inside = (x[:-1] != 32) & (x[1:] != 32)
            often = np.bincount((x[:-1] << 8 | x[1:])[inside], minlength=1 << 16)
            if often.max() < 2:
                break
            self.pairs.append((int(often.argmax()).to_bytes(2, "big"), bytes([free])))
            text = text.replace(*self.pairs[-1])

    def __missing__(self, word: bytes) -> bytes:
        return self._spelled([word])[0]

    def _spelled(self, words: list[bytes]) -> list[bytes]:
        text = b" ".join(words)
        for pair, free in self.pairs:
            text = text.replace(pair, free)
        return [b"\xff" + x + b" " for x in text.split(b" ")]

    def coded(self, words: list[bytes]) -> list[bytes]:
        """Of each word its code."""
        found = list(map(self.get, words))
        unknown = [k for k, x in enumerate(found) if x is None]
        if unknown:
            for k, x in zip(unknown, self._spelled([words[k] for k in unknown]), strict=True):
                found[k] = x
        return found


def ranks_of(coded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of coded words, joined, their ranks in the dictionary; -1 for spelled ones."""
    first = coded[starts].astype(np.int64)
    ranks = np.where(first < SHORT, first, -1)
    for n, low, rank in ((2, SHORT << 8, SHORT), (3, 251 << 16, SHORT + MIDDLE)):
        at = np.flatnonzero((lengths == n) & (first >= low >> 8 * (n - 1)) & (first < 255))
        code = np.zeros(len(at), np.int64)
        for k in range(n):
            code = code << 8 | coded[starts[at] + k]
        ranks[at] = code - low + rank
    return ranks


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def contexts_of(coded: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte: itself, the word it belongs to, and its contexts. `first` tells the words that begin a text."""
    return _contexts(b"".join(coded), np.fromiter(map(len, coded), np.int64, len(coded)), first)


def _contexts(coded: bytes, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `contexts_of`, of words that are joined."""
    byte = np.frombuffer(coded, np.uint8).astype(np.uint32)
    n, ends = len(byte), np.cumsum(lengths)
    starts = ends - lengths
    word = np.repeat(np.arange(len(lengths)), lengths)
    # sums of bytes times powers: those of a word so far are a difference, shifted back to the start of the word
    power, back = np.full(n + 1, _BASE), np.full(n + 1, _INVERSE)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((byte.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    so_far = _mixed((sums[:-1] - np.repeat(sums[starts], lengths)) * np.repeat(back[starts], lengths))
    whole = _mixed((sums[ends] - sums[starts]) * back[starts])
    whole |= np.uint32(1)
    # the last word of a one-byte code, and the last word, before each word of a text
    at = np.arange(len(lengths))
    begin = np.zeros(len(lengths), np.int64)
    begin[first] = first
    begin = np.maximum.accumulate(begin)
    common = np.concatenate([[-1], np.maximum.accumulate(np.where(lengths == 1, at, -1))[:-1]])
    after = [np.where(last >= begin, whole[last], np.uint32(0)) * _SLOT for last in (common, at - 1)]
    contexts = np.empty((len(ORDERS), n), np.uint32)
    contexts[0] = so_far
    for k in (1, 2):
        contexts[k] = (so_far ^ np.repeat(after[k - 1], lengths)) * _CONTEXT + np.uint32(k)
    # the last bytes are all that is so far of a short code; within a spelled word they stand for the words before it
    spelled = np.flatnonzero(np.repeat(byte[starts] == 255, lengths))
    spelled = spelled[spelled > starts[word[spelled]]]
    place = spelled - starts[word[spelled]]
    last = byte[spelled - 1] + np.uint32(1)
    contexts[2, spelled] = last * _CONTEXT + np.uint32(4)
    last |= np.where(place > 1, byte[spelled - 2] + np.uint32(1), np.uint32(0)) << np.uint32(9)
    contexts[1, spelled] = last * _CONTEXT + np.uint32(3)
    contexts ^= contexts >> np.uint32(15)
    return byte, word, contexts


def bits_of(byte: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte: 8 bits, their places in the trees of its halves, and, for each predictor, the slots of its bits."""
    bits, places, slots = _bits(byte, contexts)
    return bits.T, places.T, slots.swapaxes(1, 2)


def _bits(byte: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `bits_of`, the bits of all bytes one after another: what they share is then added along whole rows."""
    places = _PLACES.take(byte, axis=1, mode="clip")
    h = np.empty((len(ORDERS), 2, len(byte)), np.uint32)
    np.multiply(contexts, _SLOT, out=h[:, 0])
    np.multiply(contexts ^ ((byte >> np.uint32(4)) + np.uint32(1)) * _NODE, _SLOT, out=h[:, 1])
    h ^= h >> np.uint32(13)
    h *= _CONTEXT
    h >>= np.uint32(32 - SLOT_BITS)
    h += (np.arange(len(ORDERS), dtype=np.uint32) << np.uint32(SLOT_BITS))[:, None, None]
    # the bits of half a byte lie side by side
    slots = h.astype(np.intp)[:, :, None] ^ places.reshape(2, 4, -1)
    places[4:] += 16
    return _BITS.take(byte, axis=1, mode="clip"), places, slots.reshape(len(ORDERS), 8, -1)


def bit_rows(tokens: list[bytes], codes: Codes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte of words that stand alone: the word, 8 bits, their places, and the slots."""
    coded = list(map((Codes() if codes is None else codes).__getitem__, tokens))
    byte, word, contexts = contexts_of(coded, np.arange(len(coded)))
    return word, *bits_of(byte, contexts)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _stretched(seen: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The logit that counts give."""
    few = np.float32(0.3)
    ones = ones.astype(np.float32)
    zeros = seen.astype(np.float32)
    zeros -= ones
    ones += few
    zeros += few
    ones /= zeros
    np.log(ones, out=ones)
    return np.clip(ones, -9, 9, out=ones)


def _level(seen: np.ndarray) -> np.ndarray:
    """A level of how many counts there are, 0 for none."""
    level = (seen >= 1).astype(np.uint8)
    for most in LEVELS:
        level += seen >= most
    return level


@dataclass
class Mixer:
    """Counts of the predictors, gated weights, and the refining map."""

    table: np.ndarray  # of each slot: bits seen, and ones among them, in one number
    weights: np.ndarray  # predictor by gate
    refined: np.ndarray  # ones and seen by place and step
    states: np.ndarray | None = None  # of each slot its prediction in a byte, and its level, once the counts stay as they are
    levels: np.ndarray | None = None

    @classmethod
    def fresh(cls, ones: np.ndarray, seen: np.ndarray) -> Mixer:
        prior = _squash((np.arange(STEPS) - (STEPS - 1) / 2) * (16 / STEPS))
        refined = np.stack([np.tile(prior * 20, 32), np.full(CELLS, 20.0)])
        table = seen.astype(np.int64) * _ONE + ones.astype(np.int64)
        return cls(table, np.full((len(ORDERS) + 1, GATES), 1 / len(ORDERS), np.float32), refined)

    def freeze(self) -> Mixer:
        """From now on predictions are looked up, in steps of a logit of 0.07."""
        self.states, self.levels = np.empty(len(self.table), np.int8), np.empty(len(self.table), np.uint8)
        for at in range(0, len(self.table), 1 << SLOT_BITS):
            part = slice(at, at + (1 << SLOT_BITS))
            seen, ones = self.table[part] >> 32, self.table[part] & (_ONE - 1)
            self.states[part] = np.rint(_stretched(seen, ones) / _FINE)
            self.levels[part] = _level(seen)
        self.table = self.table[:0].copy()
        return self

    def inputs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions and gates, where no text has held anything."""
        return self._inputs(slots.swapaxes(1, 2), None)

    def _inputs(self, slots: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """As `inputs`, of bits one after another. `own`: for each bit what the text itself has seen. Gates hold for half a byte."""
        stretched = np.zeros((len(ORDERS) + 1, *slots.shape[1:]), np.float32)
        if self.states is None:
            counts = self.table.take(slots, mode="clip").view(np.uint32).reshape(*slots.shape, 2)
            stretched[:-1] = _stretched(counts[..., 1], counts[..., 0])
            levels = _level(counts[:, ::4, :, 1])
        else:
            np.multiply(self.states.take(slots, mode="clip"), _FINE, out=stretched[:-1])
            levels = self.levels.take(slots[:, ::4], mode="clip")
        known, longest = np.zeros(levels.shape[1:], np.uint8), np.ones(levels.shape[1:], np.uint8)
        for x in levels:
            known += x > 0
            np.copyto(longest, x, where=x > 0)
        gates = (known * np.uint8(len(LEVELS) + 1) + longest - np.uint8(1)) * np.uint8(len(LEVELS) + 2)
        if own is not None:
            seen = own >> np.uint32(16)
            stretched[-1] = _stretched(seen, own & np.uint32(0xFFFF))
            gates += _level(seen[::4])
        return stretched, gates.astype(np.intp)

    def probabilities(self, stretched: np.ndarray, gates: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mixed probability of a one, the same refined, and the cell of the map."""
        p, cell = _mix(stretched, gates, places.T, self.weights)
        return p.T, _refine(p, (self.refined[0] / self.refined[1]).astype(np.float32).take(cell)).T, cell.T

    def bits(self, tokens: list[bytes], codes: Codes | None = None) -> np.ndarray:
        """Bits that each word costs that stands alone, before anything adapts."""
        word, bit, places, slots = bit_rows(tokens, codes)
        _, p, _ = self.probabilities(*self.inputs(slots), places)
        return np.bincount(word, -np.log2(np.where(bit == 1, p, 1 - p)).sum(axis=1), minlength=len(tokens))

    def _learn_step(self, bit: np.ndarray, places: np.ndarray, slots: np.ndarray, own: np.ndarray | None, times: np.ndarray | None = None) -> None:
        """Weights move against the error, the map towards the bits, and then the bits are counted, those of a byte so many `times`."""
        stretched, gates = self._inputs(slots, own)
        p, cell = _mix(stretched, gates, places, self.weights)
        one, error, flat = bit.astype(np.int64), bit - p, gates.ravel()
        counted = one + _ONE
        if times is not None:
            error *= times
            counted *= times.astype(np.int64)
        often = 4 * np.bincount(flat, None if times is None else np.tile(times, 2), minlength=GATES) + DAMP
        for w, x in zip(self.weights, stretched, strict=True):
            w += RATE * np.bincount(flat, _halves(error * x), minlength=GATES) / often
        cell += cell
        cell += one
        seen = np.bincount(cell.ravel(), None if times is None else np.tile(times, 8), minlength=2 * CELLS).reshape(-1, 2)
        self.refined[0] += seen[:, 1]
        self.refined[1] += seen.sum(axis=1)
        for x in slots:
            np.add.at(self.table, x.ravel(), counted.ravel())

    def learn(self, tokens: list[bytes], counts: np.ndarray, codes: Codes | None = None) -> None:
        """A step over words that stand alone, each as often as `counts` says."""
        word, bit, places, slots = bit_rows(tokens, codes)
        self._learn_step(bit.T, places.T, slots.swapaxes(1, 2), None, counts[word])

    def learn_texts(self, texts: list[list[bytes]], codes: Codes) -> None:
        """Online steps along texts, each a list of words."""
        self._along(texts, codes, learn=True)

    def score(self, texts: list[list[bytes]], codes: Codes) -> np.ndarray:
        """log10 of the probability of each text, a list of words; its end is a word too.

        The weights and the map of each text are its own: they begin with those of the
        model and follow what went before in the text.
        """
        return self._along(texts, codes, learn=False)

    def _along(self, texts: list[list[bytes]], codes: Codes, learn: bool) -> np.ndarray:
        """Texts of like length stand side by side and advance by a window at a time."""
        return self._along_coded(codes.coded([w for words in texts for w in (*words, b"")]), [len(words) + 1 for words in texts], learn)[0]

    def _along_coded(self, found: list[bytes], words: list[int], learn: bool) -> tuple[np.ndarray, bytes, np.ndarray]:
        """As `_along`, of the coded words of texts with so many `words` each; with them joined, and their lengths."""
        out, ends = np.zeros(len(words)), np.cumsum(words).tolist()
        coded = [b"".join(found[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        every = np.fromiter(map(len, found), np.int64, len(found))
        lengths = np.split(every, ends[:-1])
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(-sizes, kind="stable")
        for at in range(0, len(order), SIDE_BY_SIDE):
            group = order[at : at + SIDE_BY_SIDE]
            out[group] = self._group([coded[k] for k in group], [lengths[k] for k in group], sizes[group], learn)
        return out, b"".join(coded), every

    def _group(self, coded: list[bytes], lengths: list[np.ndarray], sizes: np.ndarray, learn: bool) -> np.ndarray:
        """As `_along`, of coded texts of decreasing `sizes` and the lengths of their words."""
        n, total = len(coded), np.zeros(len(coded))
        words = np.fromiter(map(len, lengths), np.int64, n)
        byte, _, contexts = _contexts(b"".join(coded), np.concatenate(lengths), np.cumsum(words) - words)
        starts = np.cumsum(sizes) - sizes
        held = np.zeros(n << OWN_BITS, np.uint32)
        if not learn:
            # numpy adds at places fast only where the type is its own, not one that was unpickled
            weights = np.tile(self.weights, n).astype(np.float32)
            refined = np.tile((self.refined[0] / self.refined[1]).astype(np.float32), n)
        begin = end = 0
        while end < sizes[0]:
            # windows grow along a text, whatever stands beside it
            begin, end = end, end + min(max(WINDOW, end // 16), WIDEST)
            if begin // AGING < end // AGING:
                held = (held >> np.uint32(1)) & np.uint32(0x7FFF7FFF)
            active = int(np.searchsorted(-sizes, -begin))
            some = max(1, TAKEN // (end - begin))
            for low in range(0, active, some):
                which = np.nonzero(np.arange(begin, end) < sizes[low : min(low + some, active), None])
                text = which[0] + low
                at = starts[text] + begin + which[1]
                bit, places, slots = _bits(byte[at], contexts[:, at])
                own = slots[OWN] & ((1 << OWN_BITS) - 1)
                own += text << OWN_BITS
                before = held.take(own, mode="clip")
                np.add.at(held, own.ravel(), (bit.astype(np.uint32) + np.uint32(1 << 16)).ravel())
                if learn:
                    self._learn_step(bit, places, slots, before)
                    continue
                stretched, gates = self._inputs(slots, before)
                gates += text * GATES
                p, cell = _mix(stretched, gates, places, weights)
                cell += text * CELLS
                q = refined.take(cell, mode="clip")
                cost = np.log10(_halves(1 - np.abs(bit - _refine(p, q)), np.multiply))
                total[:active] += np.bincount(np.tile(text, 2), cost, minlength=active)
                rate, flat = np.float32(WINDOW / (end - begin)), gates.ravel()
                error = (bit - p) * (np.float32(ALONG) * rate)
                for w, x in zip(weights, stretched, strict=True):
                    np.add.at(w, flat, _halves(error * x))
                # a window visits a cell at most once a byte, so that this stays between 0 and 1
                np.add.at(refined, cell.ravel(), ((bit - q) * (np.float32(FOLLOW) * rate)).ravel())
        return total


def _halves(x: np.ndarray, fold: np.ufunc = np.add) -> np.ndarray:
    """The sums, or products, over the four bits of each half of a byte."""
    x = x.reshape(2, 4, -1)
    return fold(fold(x[:, 0], x[:, 1]), fold(x[:, 2], x[:, 3])).ravel()


def _mix(stretched: np.ndarray, gates: np.ndarray, places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed probability of a one, and its cell in a map. Several texts have their gates, weights and maps one after another."""
    mixed = np.zeros((2, 4, gates.shape[-1]), np.float32)
    for x, w in zip(stretched, weights, strict=True):
        mixed += x.reshape(mixed.shape) * w.take(gates, mode="clip")[:, None]
    mixed = mixed.reshape(places.shape)
    np.clip(mixed, -12, 12, out=mixed)
    step = (mixed + np.float32(8)) * np.float32(STEPS / 16)
    cell = np.clip(step, 0, STEPS - 1, out=step).astype(np.intp)
    cell += places * STEPS
    return _squash(mixed), cell


def _refine(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.clip(np.float32(0.6) * p + np.float32(0.4) * q, 1e-6, 1 - 1e-6)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _counted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every text with the number of its block, and after each block its words with their training counts."""
    names = ["block", "key", "held_out", "text", "token", "n"]
    block, size = TaskContext.get().partitionId() << 20, 0
    counts, others = Counter(), set()

    def words() -> pa.RecordBatch:
        tokens = list(others.union(counts))
        none = pa.nulls(len(tokens))
        columns = [pa.array([block] * len(tokens), pa.int64()), none.cast(pa.int64()), none.cast(pa.bool_()), none.cast(pa.string()), pa.array(tokens, pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([counts.get(t, 0) for t in tokens], pa.int64())], names=names)

    for batch in batches:
        start = 0
        texts, held = batch.column("text").to_pylist(), batch.column("held_out").to_pylist()
        for k in range(batch.num_rows + 1):
            if k == batch.num_rows or size >= BLOCK:
                part = batch.slice(start, k - start)
                none = pa.nulls(k - start)
                columns = [pa.array([block] * (k - start), pa.int64()), *(part.column(c) for c in names[1:4]), none.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, none.cast(pa.int64())], names=names)
                start = k
                if size >= BLOCK:
                    yield words()
                    block, size = block + 1, 0
                    counts.clear()
                    others.clear()
            if k < batch.num_rows:
                tokens = words_of(texts[k])
                size += len(texts[k] or "") + 1
                if held[k]:
                    others.update(tokens, (b"",))
                else:
                    counts.update(tokens)
                    counts[b""] += 1
    if size:
        yield words()


def dictionary(words: DataFrame) -> tuple[DataFrame, Codes, np.ndarray]:
    """The most frequent of the words (token, c), DICTIONARY at most, all or none of those with one count: their table, codes and counts."""
    known = words.filter((F.col("c") > 1) & (F.length("token") <= LONGEST))
    # there are no more different counts than the root of twice the tokens
    often = known.groupBy("c").agg(F.count("*").alias("words")).orderBy(F.col("c").desc()).toArrow()
    fit = int(np.searchsorted(np.cumsum(often["words"].to_numpy()), DICTIONARY, side="right"))
    least = often["c"][fit - 1].as_py() if fit else 1 << 62
    known = known.filter(F.col("c") >= least)
    found = known.orderBy(F.col("c").desc(), "token").toArrow()
    return known, Codes(found["token"].to_pylist()), found["c"].to_numpy()


def _learned(codes: Codes):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(ORDERS) << SLOT_BITS
        own = Mixer.fresh(np.zeros(size, np.float32), np.zeros(size, np.float32))
        start, total = own.refined.copy(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                texts = [words_of(x.as_py()) for x in batch.column("text")[at : at + TEXTS]]
                own.learn_texts(texts, codes)
                total += sum(map(len, texts)) + len(texts)
        if not total:
            return
        rows = [(-1, b"", np.concatenate([own.weights.ravel() * total, (own.refined - start).ravel(), [total]]).tobytes())]
        for part in range(size // TOGETHER):
            counts = own.table[part * TOGETHER : (part + 1) * TOGETHER]
            used = np.flatnonzero(counts)
            if len(used):
                rows.append((part, used.astype("<u2").tobytes(), counts[used].tobytes()))
        for at in range(0, len(rows), 64):
            columns = zip(zip(*rows[at : at + 64], strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in columns], names=["part", "used", "x"])

    return learn


def _added(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum over tasks of one part of the counts, or of the weights and the map."""
    part, total = key[0].as_py(), None
    for batch in rows:
        for used, x in zip(batch.column("used").to_pylist(), batch.column("x").to_pylist(), strict=True):
            if part < 0:
                total = np.frombuffer(x) + (0 if total is None else total)
            else:
                total = np.zeros((2, TOGETHER)) if total is None else total
                at, counts = np.frombuffer(used, "<u2"), np.frombuffer(x, np.int64)
                total[0, at] += counts >> 32
                total[1, at] += counts & (_ONE - 1)
    if part >= 0:
        # where a slot is seen more than a billion times its share of ones stays
        seen, ones = (total / np.maximum(total[0] / 2**30, 1)).astype(np.int64)
        total = seen * _ONE + ones
    packed = total.tobytes()
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "x"])


def train(texts: DataFrame, tokens: int, codes: Codes) -> Mixer:
    """A model of all training texts, which hold so many `tokens`. Its size is fixed, so it may travel to the driver and to every task."""
    size = len(ORDERS) << SLOT_BITS
    model = Mixer.fresh(np.zeros(size, np.float32), np.zeros(size, np.float32))
    tasks = max(1, math.ceil(tokens / TOKENS_PER_TASK))
    learned = texts.select("text").coalesce(tasks).mapInArrow(_learned(codes), "part int, used binary, x binary")
    learned = write_table(learned.groupBy("part").applyInArrow(_added, "part int, x binary"), "lm-counts")
    for row in learned.toLocalIterator():
        if row.part < 0:
            x, cut = np.frombuffer(row.x), model.weights.size
            model.weights = (x[:cut] / x[-1]).reshape(model.weights.shape).astype(np.float32)
            model.refined = model.refined + x[cut:-1].reshape(model.refined.shape)
        else:
            model.table[row.part * TOGETHER : (row.part + 1) * TOGETHER] = np.frombuffer(row.x, np.int64)
    return model.freeze()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, packed into a row per block and batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, block, counts = batch.column("token").to_pylist(), batch.column("block").to_numpy(), batch.column("c").to_numpy()
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        rows = [(int(block[at[0]]), b" ".join([tokens[k] for k in at]), counts[at].astype("<i8").tobytes()) for at in np.split(order, cuts)]
        columns = zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in columns], names=["block", "tokens", "counts"])


def _score_block(model: Mixer, codes: Codes, known: np.ndarray, total: int, distinct: int):
    unit = math.log10(total + distinct + 1)

    def score(texts: pa.Table, packed: pa.Table) -> pa.Table:
        count: dict[bytes, int] = {}
        for row in packed.to_batches():
            for tokens, c in zip(row.column("tokens").to_pylist(), row.column("counts").to_pylist(), strict=True):
                # the end of a text is the empty word
                count.update(zip(tokens.split(b" "), np.frombuffer(c, "<i8").tolist(), strict=True))
        parts = []
        for row in texts.select(["key", "held_out", "text"]).to_batches(max_chunksize=TEXTS):
            if not row.num_rows:
                continue
            tokens = [[*words_of(x), b""] for x in row.column("text").to_pylist()]
            words, every = [len(x) for x in tokens], [w for x in tokens for w in x]
            own, coded, lengths = model._along_coded(codes.coded(every), words, learn=False)
            ranks = ranks_of(np.frombuffer(coded, np.uint8), np.cumsum(lengths) - lengths, lengths)
            c, other = np.zeros(len(every), np.int64), ranks < 0
            c[~other] = known[ranks[~other]]
            c[other] = [count[every[k]] for k in np.flatnonzero(other).tolist()]
            begin, n = np.cumsum(words) - words, np.array(words, np.int64)
            base = np.add.reduceat(np.log10(c + 1.0), begin) - unit * n
            n_bytes = np.add.reduceat(np.fromiter(map(len, every), np.int64, len(every)), begin) + n
            parts.append([row.column("key"), row.column("held_out"), *map(pa.array, (n, np.add.reduceat((c > 0).astype(np.int64), begin), base, own, n_bytes))])
        names = ["key", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"]
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(x, schema=schema) for x in parts], schema)

    return score


def score_texts(df: DataFrame, doc_id: str, text: str, held_out: Column) -> DataFrame:
    """Scores of every row of `df`; the model learns from the texts where `held_out` is false.

    Returns doc_id, held_out, n_tokens and n_known (the end of the text is a token),
    train_tokens, base_score (log10, add-one word frequencies), score (log10
    probability of the text under the mixing model) and bits_per_byte. A NULL text is
    empty: its end is its only token. Repeated rows each get their score; a NULL
    `held_out` counts as false. An empty table has no rows.

    Texts are counted in blocks, so that words travel once per block and not once
    per text. Only words that the block holds come back to it; no table of all
    words is ever sent anywhere, but the dictionary, which is of bounded size.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))
    path = new_path(df.sparkSession, "lm-blocks")
    schema = "block long, key long, held_out boolean, text string, token binary, n long"
    rows.mapInArrow(_counted_blocks, schema).write.option("compression", "zstd").parquet(path)
    blocks = df.sparkSession.read.schema(schema).parquet(path)
    # a word has a row for each block that holds it; sums are taken before the shuffle too
    held = blocks.filter("token IS NOT NULL").select("token", "block", "n")
    words = write_table(held.groupBy("token").agg(F.sum("n").alias("c")), "lm-words")
    found = words.filter("c > 0").agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    total, distinct = int(found["n"]), found["v"]
    frequent, codes, known = dictionary(words)
    texts = blocks.filter("token IS NULL").select("block", "key", "held_out", "text")
    model = train(texts.filter("NOT held_out"), total, codes)
    # counts of the dictionary's words travel with it, those of all others to the blocks that hold them
    other = held.select("token", "block").join(F.broadcast(frequent.select("token")), "token", "left_anti")
    packed = other.join(words, "token").select("block", "token", "c").mapInArrow(_packed, "block long, tokens binary, counts binary")
    result = "key long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    scored = texts.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(_score_block(model, codes, known, total, distinct), result)
    return scored.select(
        F.col("key").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (F.col("score") * F.lit(-math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
