"""Prefix trie: against a plain tree, long and hot conversations, odd rows."""

import collections
import hashlib
import random
import zlib

import pytest

from stayframe.llm import q_trie, trie
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn int, role string, text string, depth int, pos string, conv string, block int, chunk int"


def table(spark, rows):
    """Turns with extra columns of clashing names."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], TURNS)


def brute_rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        own[c].append((role or "", text or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def brute_nodes(seqs):
    """Expected rows of the trie of {conv_id: sequence}."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
        ends[tuple(seqs[c])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def read(nodes):
    return sorted(map(tuple, nodes.select(*COLUMNS).collect()))


def random_turns(rng, convs, most, words="abc"):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "bot"]) if rng.random() < 0.1 else "user",
                         rng.choice(words) * rng.randint(0, 2) if rng.random() < 0.5 else "the same"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, chunk, piece", [(8, 4096, 4096), (2, 1, 2), (3, 2, 1)])
def test_against_a_plain_tree(spark, monkeypatch, width, chunk, piece):
    monkeypatch.setattr(trie, "WIDTH", width)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(q_trie, "SPAN", 3)
    rows = random_turns(random.Random(width), [*range(40), *range(95, 110), *range(250, 260), 300, 12345678901], 13)
    # copies of whole conversations
    rows += [(c + 400, t, r, x) for c, t, r, x in rows if c is not None and c < 20]
    assert read(trie.prefixes(q_trie.rebuilt(table(spark, rows)))) == brute_nodes(brute_rebuilt(rows))


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    monkeypatch.setattr(q_trie, "SPAN", 64)
    rng = random.Random(4)
    rows = random_turns(rng, range(100, 130), 6) + [(100, t, "user", rng.choice("ab")) for t in range(1000)]
    rows += [(200, t, "user", "ab"[t % 2]) for t in range(700)] + [(201, t, "user", "ab"[t % 2]) for t in range(500)]
    assert read(trie.prefixes(q_trie.rebuilt(table(spark, rows)))) == brute_nodes(brute_rebuilt(rows))


def test_one_conversation_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    rng = random.Random(6)
    rows = random_turns(rng, range(40), 6) + [(7, 100 + t, "user", rng.choice("ab")) for t in range(900)]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert read(trie.prefixes(q_trie.rebuilt(table(spark, rows)))) == brute_nodes(brute_rebuilt(rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_odd_rows(spark):
    long = "y" * 200_000
    rows = [(None, 1, "user", "lost"), (7, None, "user", "first"), (7, 2, None, None), (7, 2, None, None), (7, 2, "", "z"),
            (8, 1, "user", ""), (9, 1, "a", "bc"), (10, 1, "ab", "c"), (11, 1, "user", long), (500, 1, "user", long),
            (501, 1, "x", "gone"), (503, 0, None, "é\n,")]
    got = trie.prefixes(q_trie.rebuilt(table(spark, rows)))
    assert read(got) == brute_nodes(brute_rebuilt(rows))
    assert trie.prefixes(q_trie.rebuilt(table(spark, []))).count() == 0
    # a turn that only a null id has is not in the trie; last turns come back as text
    texts = {(r.role, r.text) for r in trie.labelled(got, table(spark, rows)).collect()}
    assert texts == {(None, None), *(t for q in brute_rebuilt(rows).values() for t in q)}
    assert ("user", "lost") not in texts and len(texts) > 5
    # all turnless: only the root
    bare = spark.createDataFrame([(1, None, None, None), (5, None, None, None)],
                                 "conv_id long, depth long, turn binary, chars long")
    assert read(trie.prefixes(bare)) == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,5").hexdigest())]


def test_query_against_sql_and_a_plain_tree(spark):
    ok, why = compare(q_trie.op12_prefix_trie(spark, SF), duck(SF), q_trie.ORACLE_SQL)
    assert ok, why
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert read(q_trie.op12_prefix_trie(spark, SF)) == brute_nodes(brute_rebuilt(rows))


def test_nodes_come_from_a_rollup_without_python(spark):
    rows = q_trie.rebuilt(table(spark, [(1, 1, "user", "a")]))
    plan = trie._rollup(trie._blocks(rows, "conv_id")[0], "max(n_turns) AS longest")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Python" not in plan and "MapInArrow" not in plan
