"""License notices against a plain search word by word."""

import math
import random
import re

import pytest
from conftest import SF

from cartwheel.llm import licenses
from cartwheel.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def plain(texts, notices=licenses.NOTICES):
    """Per text: words, and per notice its starts and score."""
    split = [words_of(t) for t in texts]
    rare = {w: math.log((1 + len(texts)) / (1 + sum(w in s for s in map(set, split)))) for n in notices for w in n.words}
    out = []
    for words in split:
        found = []
        for n in notices:
            at = lambda s, k, n=n: 0 <= s + k < len(words) and words[s + k] == n.words[k]  # noqa: B023, E731
            starts = [s for s in range(-len(n.words), len(words)) if all(at(s, k) for k in n.key_places())]
            if starts:
                total = sum(rare[w] for w in n.words)
                seen = sum(rare[w] for k, w in enumerate(n.words) if any(at(s, k) for s in starts))
                found.append((n.label, n.base, starts, seen / total if total else 1.0))
        out.append((words, found))
    return out


def check(rows, texts):
    for row, (words, found) in zip(rows, plain(texts), strict=True):
        assert row.n_words == len(words)
        assert [(m.label, m.base, list(m.starts)) for m in row.licenses] == [f[:3] for f in found]
        assert [m.score for m in row.licenses] == pytest.approx([f[3] for f in found])


def test_notices_in_odd_texts(spark):
    chance = random.Random(12)
    vocabulary = [w for n in licenses.NOTICES for w in n.words] + ["über", "x9", "Kits", "MIT's"]
    texts = [None, "", " -- ", "Under THE MIT-License.", "under the mit license", "under the mİt license", "cc by nc " * 20_000]
    texts += ["K by nc", "CC BY\x00NC 4.0", "hereby granted free of charge", "version 2 0", "the MIT license under the mit license"]
    for _ in range(300):
        parts = []
        for _ in range(chance.randrange(6)):
            n = chance.choice(licenses.NOTICES)
            k = chance.randrange(len(n.words)) if chance.random() < 0.4 else 0
            parts += n.words[k:] if chance.random() < 0.8 else n.words[: k + 2]
            parts += [chance.choice(vocabulary) for _ in range(chance.randrange(4))]
        texts.append(chance.choice([" ", ", ", "\n"]).join(w.upper() if chance.random() < 0.1 else w for w in parts))
    df = spark.createDataFrame([(i, t, "a", 1, 2, [3]) for i, t in enumerate(texts)], "doc_id long, text string, _words string, licenses int, hits int, _hits array<int>")
    out = licenses.find_licenses(df, "text")
    assert out.columns == ["doc_id", "text", "_words", "hits", "_hits", "n_words", "licenses"]
    check(out.orderBy("doc_id").collect(), texts)
    assert licenses.find_licenses(df.limit(0), "text").count() == 0
    assert sum(len(r.licenses) for r in out.unionByName(out).filter("doc_id IS NOT NULL").collect()) == 2 * sum(len(f) for _, f in plain(texts))


def test_query_against_the_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op12_licenses"](spark, SF).collect()}
    for key, (words, found) in zip(texts, plain(list(texts.values())), strict=True):
        r, places = rows[key], [s for _, base, starts, _ in found if base for s in starts]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({f[0] for f in found if f[1]})) and r.labels == ",".join(sorted({f[0] for f in found}))
        assert r.score == pytest.approx(max((f[3] for f in found), default=0.0), abs=1e-6) and 0 <= r.score <= 1
    assert sum(r.n_base for r in rows.values()) > 0
