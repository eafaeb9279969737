"""The conversation trie against dictionaries of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rollbook.llm import trie
from rollbook.llm.queries import GRAFT, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def grafted(own):
    def head(c):
        return zlib.crc32(str(c).encode()) % 6

    return {c: [*own.get(c - int(np.fmod(c, 100)), [])[: head(c)], *turns[head(c) :]] for c, turns in own.items()}


def brute(rows, graft):
    own = defaultdict(list)
    for c, turn, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()),
    ):
        own[c].append((role or "", text or ""))
    paths = grafted(own) if graft else own
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    return sorted((
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    ), key=str)


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def drawn(seed, n=260, words="abc"):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-150, 900), n, replace=False).tolist():
        size = int(rng.integers(1, 9))
        rows += [(c, None if k == 0 and c % 7 == 0 else k, str(rng.choice(["user", "assistant"])), str(rng.choice(list(words)))) for k in range(size)]
    return rows


HOT = [(c, k, "user", "x" * k) for c in range(5000, 6000, 3) for k in range(1, 3)]  # many copies: ends of several blocks
CASES = {
    "drawn": drawn(1),
    "alike": drawn(2, words="a"),
    "apart": drawn(3, words="abcdefghijklmnopqrstuvwxyz"),
    "odd": [
        (None, 1, "user", "x"), (1, None, None, None), (1, None, None, None), (1, 1, "user", "é😀"), (2, 1, "", "us"), (3, 1, "u", "s"), (4, 1, None, ""), (4, 1, "b", "a"), (4, 1, "a", "b"),
        (100, 1, "user", "hello"), (101, 5, "user", "hello"), (102, 1, "user", "hello"), (103, 1, "user", "own"), (2**40 + 5, 1, "user", "far"), (205, 1, "user", "no base"),
    ],
    "copies": [*HOT, *drawn(4, 40)],
    "long": [(c, k, "user", f"{k % 3}") for c in (100, 107, 109) for k in range(90)] + drawn(5, 30, "012"),
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("graft", [None, GRAFT])
def test_equals_brute_force(spark, monkeypatch, name, graft):
    rows = CASES[name]
    if name in ("copies", "long"):
        monkeypatch.setattr(trie, "STRETCH", 4)
        monkeypatch.setattr(trie, "IDS", 5)
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA + ", n_convs string, k1 int").repartition(5)
    found = results(trie.trie(df, graft).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
    assert found == brute(rows, graft)


@pytest.mark.parametrize("bits", [3])
def test_a_sketch_too_small_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(trie, "BITS", bits)
    rows = [*CASES["drawn"], *CASES["apart"]]
    assert results(trie.trie(spark.createDataFrame(rows, SCHEMA), GRAFT)) == brute(rows, True)


@pytest.fixture
def small_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_conversations_over_several_ranges(spark, small_ranges):
    rows = CASES["long"]
    df = spark.createDataFrame(rows, SCHEMA)
    _, runs = trie.placed(df)
    assert runs.filter("conv_id IN (100, 107)").filter("several").count() >= 3
    for graft in (None, GRAFT):
        assert results(trie.trie(df, graft)) == brute(rows, graft)


def test_only_shared_prefixes_are_grouped(spark):
    rows = [(c, k, "user", f"{c} {k}" if k else "hello") for c in range(300) for k in range(6)]
    found, _ = trie.prefixes(spark.createDataFrame(rows, SCHEMA))
    estimates = trie.estimated(found, trie.sketched(found, 14))
    assert estimates.filter("e > 1").count() < 1.1 * 300 and estimates.filter("depth = 1 AND e < 255").count() == 0


def test_empty(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA), GRAFT).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA), GRAFT).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(QUERIES["op12_conversation_trie"](spark, sf_dir)) == brute(rows, True)
