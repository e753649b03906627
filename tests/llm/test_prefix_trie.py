"""The prefix trie against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vigor.llm import prefix_trie


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    made = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + t[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
            if d:
                kids[made[c][:d - 1]].add(made[c][:d])
    out, total = [], {}
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = (sum(total[k][0] for k in kids[p]) or 1, own_saved + sum(total[k][1] for k in kids[p]))
        ends = ",".join(str(c) for c in members[p] if len(made[c]) == len(p))
        out.append((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def some(rnd, n, longest):
    rows = []
    for c in range(n):
        if rnd.random() < 0.8:
            for t in range(rnd.randint(1, longest)):
                rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["", "a", "é", "b c", None])))
    return rows


@pytest.mark.parametrize("segment,convs,longest", [(1024, 2048, 6), (4, 3, 14), (3, 1, 20), (1024, 7, 14)])
def test_trie(spark, monkeypatch, segment, convs, longest):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "SHARD_CONVS", convs)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = some(random.Random(segment * convs), 160, longest)
    rows += [(200 + i, t, "user", "same") for i in range(40) for t in range(30)]
    rows += [(300, None, "user", "first"), (300, 1, "b", "x"), (300, 1, "a", "y"), (300, 1, "a", "y"), (None, 0, "user", "none"), (2 ** 62, 0, None, None)]
    rnd = random.Random(5)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash")).withColumn("pos", F.lit(1))
    got = Counter(tuple(r) for r in prefix_trie.trie(df.repartition(5)).collect())
    assert got == brute(rows)


def test_one_conversation_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    rows = [(c, t, "user", f"t{t % 7}") for c in (10, 11, 12) for t in range(300 if c < 12 else 3)] + [(20, 0, "user", "same")] * 50
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert Counter(tuple(r) for r in prefix_trie.trie(df).collect()) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(df).count() == 0
