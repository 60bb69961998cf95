"""Toxic texts by a learned lexicon: Levenshtein automata over its trie, and context windows that spare quotations."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.scratch import write_table

# labelled rows that lexicon and weights are learned from (by hash of the id), and entries of the lexicon: bounds for the driver
LABELLED_ROWS, LEXICON_ENTRIES = 20_000, 2_000
# a term must be this much likelier among toxic texts (log-likelihood ratio) and toxic in this share of its texts;
# one that is toxic in fewer than SURE of them counts as a weak term
EVIDENCE, PRECISION, SURE = 14.0, 0.3, 0.95
# beginnings of words of these lengths are terms too: inflected forms share them
STEMS = range(4, 10)
# one edit is allowed in words of at least this length
FUZZY_LENGTH = 5
# words on either side of a term that its context score looks at
WINDOW = 4
REMEMBERED = 200_000

_AROUND = re.compile(r"^[\W_]+|[\W_]+$")
_QUOTES = frozenset("\"“”„‟«»‹›‘’‚`")
FEATURES = ("words", "stems", "weak", "quoted", "any", "log_share")
# what a misspelled word counts beside a word as it is learned
MISSPELLED = 0.7


class Automaton:
    """Levenshtein automaton of one word: accepts whatever is within `edits` edits of it.

    A state holds (position in the word, edits used) for the positions that can
    still be reached; a letter that no position survives leads to the empty state.
    """

    def __init__(self, word: str, edits: int) -> None:
        self.word, self.edits = word, edits

    def start(self) -> tuple[tuple[int, int], ...]:
        return tuple((i, i) for i in range(min(self.edits, len(self.word)) + 1))

    def step(self, state: tuple[tuple[int, int], ...], letter: str) -> tuple[tuple[int, int], ...]:
        word, edits = self.word, self.edits
        reached: dict[int, int] = {}
        for i, used in state:
            if used < edits and used + 1 < reached.get(i, edits + 1):
                reached[i] = used + 1  # a letter too many
            if i < len(word):
                cost = used + (word[i] != letter)
                if cost <= edits and cost < reached.get(i + 1, edits + 1):
                    reached[i + 1] = cost
        for i in sorted(reached):  # letters left out
            k, used = i, reached[i]
            while k < len(word) and used < edits:
                k, used = k + 1, used + 1
                if used < reached.get(k, edits + 1):
                    reached[k] = used
        return tuple(sorted(reached.items()))

    def accepts(self, state: tuple[tuple[int, int], ...]) -> bool:
        return any(i == len(self.word) for i, _ in state)


@dataclass
class Lexicon:
    """Whole words and stems. `find` says how a token meets them."""

    words: list[str]
    stems: list[str]
    weak: list[str] = field(default_factory=list)  # those of them that clean texts hold too
    innocent: list[str] = field(default_factory=list)  # words of clean texts that are an edit away from a term
    trie: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        for word in self.words:
            node = self.trie
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word
        self.exact, self.unsure, self.spared = frozenset(self.words), frozenset(self.weak), frozenset(self.innocent)
        self.stem_set, self.stem_lengths = frozenset(self.stems), sorted({len(s) for s in self.stems})
        # one edit leaves the first or the second half of a word as it is
        long = [w for w in self.words if len(w) >= FUZZY_LENGTH and w not in self.unsure]
        self.heads, self.tails = frozenset(w[: len(w) // 2] for w in long), frozenset(w[len(w) // 2 :] for w in long)
        self.head_lengths, self.tail_lengths = sorted({len(x) for x in self.heads}), sorted({len(x) for x in self.tails})
        self.lengths = frozenset(n + d for n in map(len, long) for d in (-1, 0, 1))

    def find(self, raw: str) -> int:
        """-1 for no term, else 0 a word, 1 a stem, 2 a weak one, 3 a misspelled word. `raw` is lower case."""
        token = _AROUND.sub("", raw)
        if token in self.exact:
            return 2 if token in self.unsure else 0
        for n in self.stem_lengths:
            if token[:n] in self.stem_set and len(token) >= n:
                return 2 if token[:n] in self.unsure else 1
        if token in self.spared:
            return -1
        # marks inside or around a word may stand for letters
        for form in (token, raw) if raw != token else (token,):
            if len(form) in self.lengths and self._misspelled(form):
                return 3
        return -1

    def _misspelled(self, token: str) -> bool:
        if not any(token[:n] in self.heads for n in self.head_lengths) and not any(token[-n:] in self.tails for n in self.tail_lengths):
            return False
        automaton = Automaton(token, 1)
        waiting = [(self.trie, automaton.start())]
        while waiting:
            node, state = waiting.pop()
            for letter, below in node.items():
                if letter == "":
                    if len(below) >= FUZZY_LENGTH and below not in self.unsure and automaton.accepts(state):
                        return True
                else:
                    reached = automaton.step(state, letter)
                    if reached:
                        waiting.append((below, reached))
        return False


class _Seen(dict):
    """How tokens met so far meet the lexicon."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.lexicon.find(token)
        if len(token) <= 64:
            self[token] = found
        return found


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the term at this place is mentioned rather than used: quotation marks close around it within the window."""
    own = tokens[at]
    if own[0] in _QUOTES and own.rstrip(".,;:!?")[-1] in _QUOTES and len(own) > 1:
        return True
    opened = own[0] in _QUOTES
    for k in range(at - 1, max(at - WINDOW, 0) - 1, -1):
        if opened:
            break
        if tokens[k].rstrip(".,;:!?")[-1:] in _QUOTES and len(tokens[k]) > 1:
            return False
        opened = tokens[k][0] in _QUOTES
    if not opened:
        return False
    return any(
        tokens[k].rstrip(".,;:!?")[-1:] in _QUOTES and (k > at or len(own) > 1) for k in range(at, min(at + WINDOW, len(tokens) - 1) + 1)
    )


def features(text: str | None, seen: _Seen) -> list[float]:
    """Counts of terms by kind (log scale), of quoted ones, whether there is any, and their share of the words."""
    tokens = (text or "").lower().split()
    counts = [0, 0, 0, 0, 0]
    for at, kind in enumerate(map(seen.__getitem__, tokens)):
        if kind >= 0:
            counts[4 if quoted(tokens, at) else kind] += 1
    words, stems, weak, misspelled, mentioned = counts
    return [
        math.log1p(words + MISSPELLED * misspelled),
        math.log1p(stems),
        math.log1p(weak),
        math.log1p(mentioned),
        float(words + stems + misspelled > 0),
        math.log1p(1000 * (words + stems + weak + misspelled) / max(len(tokens), 1)),
    ]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # one per feature, then the intercept

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _regress(rows: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.column_stack([rows, np.ones(len(rows))])
    w, shrink = np.zeros(x.shape[1]), np.diag([ridge] * rows.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (toxic - p) - shrink @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _copy_key(text: str | None) -> int:
    """Smallest hash of three words in a row: near copies mostly share it, and then count once."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    grams = (b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2)))
    return min(xxhash.xxh64_intdigest(g) for g in grams) >> 1


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([_copy_key(value.as_py()) for value in batch.column("text")], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("text"), keys], names=["toxic", "text", "key"])


def _terms(text: str | None) -> set[str]:
    """Whole words (with a closing mark) and beginnings of words that a text holds."""
    words = {_AROUND.sub("", w) for w in (text or "").lower().split()}
    terms = {f"{w}$" for w in words if 3 <= len(w) <= 40}
    for n in STEMS:
        terms.update(w[:n] for w in words if len(w) >= n)
    return terms


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        terms = list(counts[0] | counts[1])
        columns = [pa.array(terms), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            counts[toxic.as_py()].update(_terms(text.as_py()))
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield out()
    yield out()


def _lexicon(sample: DataFrame) -> Lexicon:
    """Terms that tell toxic texts, strongest first; a term that begins or continues a stronger one adds nothing."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Lexicon([], [])
    base = n[1] / (n[0] + n[1])
    counts = sample.select("text", "toxic").mapInArrow(_counted, "term string, clean long, toxic long")
    total = write_table(counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-terms")
    share = (F.col("toxic") / (F.col("toxic") + F.col("clean"))).alias("share")
    gain = F.col("toxic") * F.log(F.col("share") / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - F.col("share")) / (1 - base))
    ).otherwise(0.0)
    strong = (
        total.filter("toxic > 0")
        .select("term", "toxic", "clean", share)
        .withColumn("gain", gain)
        .filter((F.col("gain") >= EVIDENCE) & (F.col("share") >= max(PRECISION, base)))
        .orderBy(F.desc("gain"), F.desc(F.length("term")), "term")
        .limit(LEXICON_ENTRIES)
        .collect()
    )
    words: list[str] = []
    stems: list[str] = []
    weak: list[str] = []
    for row in strong:
        term = row["term"]
        whole = term.removesuffix("$")
        if any(whole.startswith(w) or w.startswith(whole) for w in words + stems):
            continue
        (words if term.endswith("$") else stems).append(whole)
        if row["share"] < SURE:
            weak.append(whole)
    lexicon = Lexicon(words, stems, weak)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([lexicon.find(t.as_py()[:-1]) == 3 for t in batch.column("term")], pa.bool_()))

    # a word that is an edit away from a term, and no likelier toxic than others, is a word of its own
    own = total.filter(F.col("term").endswith("$") & (F.col("toxic") < PRECISION * (F.col("toxic") + F.col("clean"))))
    near_words = own.select("term", "clean").mapInArrow(near, "term string, clean long").orderBy(F.desc("clean"), "term").limit(LEXICON_ENTRIES)
    return Lexicon(words, stems, weak, [r["term"][:-1] for r in near_words.collect()])


def _measured(lexicon: Lexicon):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(lexicon)
        for batch in batches:
            rows = [features(value.as_py(), seen) for value in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    return measure


def fit(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, train: Column) -> Model:
    """Lexicon and weights from at most LABELLED_ROWS labelled rows, those with the smallest hash of their id.

    `train` tells on the columns of `labels` which rows may be used. Labels other
    than 0 and 1 are left out. Without both kinds of label nothing is toxic.
    """
    chosen = (
        labels.filter(train & F.col(label).isin(0, 1) & F.col(label_id).isNotNull())
        .select(F.col(label_id).alias("_id"), F.col(label).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id", F.lit(29)), "_id", "toxic")
        .limit(LABELLED_ROWS)
    )
    # at most LABELLED_ROWS pairs of numbers: small enough to send everywhere
    picked = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    sample = write_table(picked.mapInArrow(_keyed, "toxic int, text string, key long"), "toxicity-sample")
    lexicon = _lexicon(sample.dropDuplicates(["key", "toxic"]))
    seen = sample.select("toxic", "text").mapInArrow(_measured(lexicon), "toxic int, x array<double>").toArrow()
    toxic = seen["toxic"].to_numpy().astype(float)
    if not 0 < toxic.sum() < len(toxic):
        return Model(lexicon, np.array([0.0] * len(FEATURES) + [-10.0]))
    rows = np.array(seen["x"].to_pylist())
    order = np.lexsort((*rows.T, toxic))  # the same sums whatever the order of the rows
    return Model(lexicon, _regress(rows[order], toxic[order]))


def score_texts(df: DataFrame, text: str, model: Model, score: str = "score") -> DataFrame:
    """`df` with the probability that each whole text is toxic; a column named like it is replaced.

    A NULL or empty text, and one without terms, gets the probability of texts
    without terms. Every row is scored on its own.
    """
    df = df.drop(score)
    names = df.columns
    schema = df.select("*", F.lit(0.0).alias(score)).schema

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(model.lexicon)
        for batch in batches:
            rows = np.array([features(value.as_py(), seen) for value in batch.column(text)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(rows), pa.float64())], names=[*names, score])

    return df.mapInArrow(rate, schema)
