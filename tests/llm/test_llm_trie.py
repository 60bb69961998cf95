"""The trie of conversation openings against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import SF

from cartwheel.llm import prefix_trie
from cartwheel.llm.queries import QUERIES
from cartwheel.scratch import write_table

SCHEMA = "conv_id long, turn long, role string, text string, conv int, depth string, block int, x long"


def sequences(rows):
    """Conversations as lists of (role, text); rows are (conv, turn, role, text)."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[conv].append((turn is not None, turn, digest, (role, text)))
    return {c: [x[-1] for x in sorted(turns, key=lambda x: x[:1] + (x[1] or 0,) + x[2:3])] for c, turns in found.items()}


def spliced(found):
    out = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = found.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(found):
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, held in members.items():
        own = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    rows = set()
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(found[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def as_set(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", 2, 3) for r in rows], SCHEMA)


@pytest.fixture(params=["1", "3", "7", "10000"])
def batches(spark, request):
    """From one block a batch to all of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, before)


def conversations(seed, n=60):
    """Copies, openings that are conversations themselves, long chains and one hot conversation."""
    chance, rows, last = random.Random(seed), [], {}
    for c in range(n):
        turns = list(chance.choice(list(last.values()))) if last and chance.random() < 0.7 else []
        turns = turns[: chance.randrange(len(turns) + 1)] if chance.random() < 0.5 else turns
        turns += [(chance.choice("ua"), chance.choice(["", "é", "yes", "no no"])) for _ in range(chance.choice([0, 0, 1, 3, 25]))]
        last[c] = turns
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(1000, k, "u", "x") for k in range(300)] + [(1001, k, "u", "x") for k in range(290)] + [(1002, k, "u", "x" if k != 150 else "y") for k in range(200)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2, 16])
def test_trie_over_batch_and_block_borders(spark, batches, block):
    rows = conversations(block)
    found = as_set(prefix_trie.prefix_trie(table(spark, rows).repartition(5), "conv_id", "turn", "role", "text", block))
    assert found == plain_trie(sequences(rows))


def test_odd_rows(spark):
    rows = [(1, None, "u", "a"), (1, 0, None, None), (1, 0, None, None), (1, 5, "u", "b"), (None, 1, "u", "lost"), (2, 0, "", ""), (3, 1, "a", "x" * 100_000)]
    rows += [(4, 2, "u", "tie"), (4, 2, "a", "tie"), (-5, 0, "u", "below zero")]
    assert as_set(prefix_trie.prefix_trie(table(spark, rows), "conv_id", "turn", "role", "text")) == plain_trie(sequences(rows))
    assert prefix_trie.prefix_trie(table(spark, rows).limit(0), "conv_id", "turn", "role", "text").count() == 0


def test_shared_openings(spark, batches):
    """Whole rebuilt conversations, some of them without any turn."""
    rows = [r for r in conversations(5, 120) if r[0] % 5 or r[0] % 3]
    turns = prefix_trie.numbered_turns(table(spark, rows), "conv_id", "turn", "role", "text")
    convs, spun = prefix_trie.with_shared_openings(turns)
    expected = spliced(sequences(rows))
    assert any(not t for t in expected.values())
    assert {r.conv: r.length for r in convs.collect()} == {c: len(t) for c, t in expected.items()}
    assert as_set(write_table(prefix_trie.trie(convs, spun), "test-trie")) == plain_trie(expected)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_set(QUERIES["op11_prefix_trie"](spark, SF)) == plain_trie(spliced(sequences(rows)))
