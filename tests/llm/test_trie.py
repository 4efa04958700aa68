import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from isotherm.llm import trie

DDL = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append((c, d == len(rebuilt)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = set()
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        n = len(members[node])
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", node[-1][1].encode())) if node else 0
        below = [totals[x] for x in children[node]]
        totals[node] = (sum(x[0] for x in below) or int(not below), (n - 1) * words + sum(x[1] for x in below))
        ends = ",".join(str(c) for c in sorted(c for c, end in members[node] if end))
        parent = min(members[node[:-1]])[0] if node else None
        out.add((min(members[node])[0], len(node), parent, n, len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_of(spark, rows):
    found = trie.conversation_trie(spark.createDataFrame(rows, DDL)).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def random_talks(seed, convs, most_turns, texts):
    pick = random.Random(seed)
    roles = ["user", "assistant", None]
    rows = [(c, t, pick.choice(roles[: 1 + t % 3]), pick.choice(texts)) for c in convs for t in range(pick.randrange(most_turns + 1))]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard_rows,block", [(1, 32768, 32), (2, 3, 32), (3, 2, 3), (4, 4, 2), (5, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, shard_rows, block):
    monkeypatch.setattr(trie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = random_talks(seed, range(40), 6, ["a", "a b", "b  c\td", None, ""])
    rows += [(1000 + i, t, "user", "same words here") for i in range(12) for t in range(4)]  # copies, over many shards
    rows += [(c, None, "system", "first") for c in (3, 1001)]
    assert trie_of(spark, rows) == brute_force(rows)


def test_long_conversations_cross_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_ROWS", 2)
    rows = [(c, t, "user", f"w{t} x") for c, n in ((100, 150), (101, 150), (102, 32), (103, 33), (104, 97), (105, 64)) for t in range(n)]
    rows[140] = (*rows[140][:3], "another")
    assert trie_of(spark, rows) == brute_force(rows)


def test_one_conversation_in_many_tasks(spark):
    rows = [(5, t, "user", f"t{t % 7}") for t in range(300)] + [(1, 0, "user", "x")]
    turns = trie.numbered_turns(spark.createDataFrame(rows, DDL)).where("conv_id = 5").collect()
    assert sorted(r["nth"] for r in turns) == list(range(1, 301))


def test_ties_repeated_rows_and_nulls(spark):
    rows = [(7, 1, "b", "x"), (7, 1, "a", "z"), (7, 1, "a", "y"), (7, 1, "a", "y"), (7, None, None, None), (None, 1, "user", "lost"), (8, 0, None, "x")]
    assert trie_of(spark, rows) == brute_force(rows)


def test_empty_table_and_clashing_columns(spark):
    assert trie_of(spark, []) == set()
    rows = random_talks(9, range(30), 4, ["a", "b c"])
    extra = "block path words shard nth digest hi lo tail kind depth length m h base".split()
    turns = spark.createDataFrame(rows, DDL).selectExpr("*", *(f"'x' AS {name}" for name in extra))
    assert {tuple(r) for r in trie.conversation_trie(turns).collect()} == brute_force(rows)
