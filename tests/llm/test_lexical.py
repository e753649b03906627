"""Ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigor.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(docs, items, k):
    bags = [(d, Counter(w), len(w)) for d, w in ((d, words(t)) for d, t in docs) if w]
    n, total = len(bags), sum(x for _, _, x in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = Counter()
    for item, text in items:
        scores = []
        for d, bag, size in bags:
            m = 25 + 75 * size * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t, c in Counter(words(text)).items() if t in bag)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        for rank, (s, null, d) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if null else d, -s] += 1
    return out


def found(docs, items, k):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(docs, items, k).collect())


def some(seed, n):
    rnd = random.Random(seed)
    pool = [f"{a}{b}" for a in ("the", "É", "é", "x9", "Word", "ß") for b in range(12)]
    text = lambda: "".join(rnd.choice(pool[:rnd.randint(1, len(pool))]) + rnd.choice([" ", ", ", "_", "\n"]) for _ in range(int(rnd.paretovariate(0.7))))[:4000]
    return [(i, text()) for i in range(n)]


@pytest.mark.parametrize("bucket,focus,seeds,block", [(4096, 8, 8192, 1 << 20), (16, 2, 32, 1 << 20), (7, 1, 3, 200), (5, 0, 0, 1 << 20)])
def test_search(spark, monkeypatch, bucket, focus, seeds, block):
    for name, value in (("BUCKET", bucket), ("FOCUS", focus), ("SEEDS", seeds), ("ITEM_BYTES", block)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = some(bucket, 300), some(bucket + 1, 12)
    docs += [(400, None), (401, ""), (402, " .,;"), (403, "the1 " * 20_000), (404, docs[3][1]), (5, docs[3][1]), (None, docs[3][1]), (None, None), (405, "q" * 5000)]
    items += [(20, None), (21, ""), (22, "nowhere"), (3, items[3][1]), (3, items[3][1]), (None, "the1 THE1 q"), (23, "q" * 5000), (24, docs[3][1])]
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumn("norm", F.lit("clash")).withColumn("terms", F.lit(1))
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("clash"))
    assert found(left.repartition(5), right, 4) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0 == lexical.search(docs, items.limit(0)).count()
    assert lexical.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_prune_and_lose_nothing():
    rnd = np.random.default_rng(1)
    items = lexical.item_block([0, 1], ["a b c a", "c d"])
    rows = []
    for d in range(400):
        term = np.flatnonzero(rnd.random(4) < 0.5).astype("<i4")
        impact = (rnd.random(len(term)) ** 8 * 1e6).astype("<i8")
        rows.append((d, math.sqrt(float((impact.astype(float) ** 2).sum())), term.tobytes(), impact.tobytes()))
    rows.sort(key=lambda r: -r[1])
    search = lexical.Search(items, 5)
    for i in range(0, 400, 20):
        search.take(lexical.Bucket(rows[i:i + 20], 4))
    for i in range(2):
        q = np.zeros(4, np.int64)
        q[items.term[items.item == i]] = items.count[items.item == i]
        scores = sorted((-int(q[np.frombuffer(t, "<i4")] @ np.frombuffer(x, "<i8")), False, d) for d, _, t, x in rows)
        assert search.best[i] == scores[:5]
    assert search.seen[0] == 800 == search.seen[1:].sum() and search.seen[4] < 200 and search.seen[1] > 0
