"""Runs of words against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from conftest import SF

from cartwheel.llm import periodic
from cartwheel.llm.queries import QUERIES


def plain_runs(words, least_length=6, least_exponent=4):
    """Every maximal stretch of each period, kept where no smaller period fits."""
    found, n = [], len(words)
    for period in range(1, n // least_exponent + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            if j > i and length >= max(least_length, least_exponent * period):
                part = words[i : i + length]
                if not any(part[:-q] == part[q:] for q in range(1, period)):
                    found.append((i, length, period))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_equal_the_plain_search(letters):
    chance = random.Random(letters)
    for _ in range(400):
        words = [chance.randrange(letters) for _ in range(chance.randrange(60))]
        for _ in range(chance.randrange(4)):
            part = [chance.randrange(letters) for _ in range(chance.randrange(1, 9))]
            words += part * chance.randrange(6) + part[: chance.randrange(len(part))]
        for length, exponent in ((6, 4), (2, 2), (1, 3)):
            assert periodic.runs_of(words, length, exponent) == plain_runs(words, length, exponent), words


def test_long_sets_of_positions():
    """A word repeated many times, and a period that breaks once in a while."""
    assert periodic.runs_of([7] * 30_000) == [(0, 30_000, 1)]
    words = ([1, 2, 3] * 1_500 + [4]) * 5
    block = 4_501
    expected = [(k * block, block - 1, 3) for k in range(5)] + [(0, 5 * block, block)]
    assert periodic.runs_of(words) == sorted(expected, key=lambda r: (r[0], r[2]))
    places = periodic.Positions(0)
    order = random.Random(1).sample(range(1, 9_000, 3), 2_999)
    for x in order:
        places.add(x)
    assert list(places) == sorted([0, *order]) and places.around(5) == (4, 7) and places.around(9_000) == (max(order), None)


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "a " * 6, "a " * 5, "é x " * 9, "a b " * 70_000, "x\x1cy z " * 8, "\x00 " * 7]
    rows = [(i, t, "mine", 1.5) for i, t in enumerate([*texts, *texts])]
    df = spark.createDataFrame([*rows, (None, "q " * 8, None, None)], "doc_id long, text string, runs string, order double")
    out = periodic.find_runs(df, "text").collect()
    assert len(out) == len(rows) + 1
    for r in out:
        words = split(r.text)
        runs = [tuple(x) for x in r.runs]
        if len(words) < 1_000:
            assert runs == plain_runs(words)
        else:
            assert runs == [(0, 140_000, 2)]
        assert r.collapsed == plain_collapse(words, runs)
    assert periodic.find_runs(df.limit(0), "text").count() == 0


def rebuilt(doc_id, text):
    h = zlib.crc32(str(doc_id).encode())
    g, words = h // 10, split(text)
    n = len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_against_the_plain_search(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    compared = 0
    for r in rows:
        words = rebuilt(r.doc_id, texts[r.doc_id])
        if len(words) > 1_500 and r.n_runs:
            continue
        compared += 1
        runs = plain_runs(words) if len(words) <= 1_500 else []
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert compared > 0.95 * len(texts) and sum(r.n_runs > 0 for r in rows) > 10
