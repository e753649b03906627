"""Words and shingles of batches of any length against plain Python."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigor.llm import ngram_join, quality_rules
from vigor.llm import words as W
from vigor.llm.shared import CHUNK_BYTES


def of(*texts):
    return W.words(*W.column_bytes(pa.array(texts, pa.string())))


def thue_morse(first):
    return "".join("ab"[(bin(i).count("1") + first) % 2] for i in range(1024))


@pytest.mark.parametrize("n", range(13))
def test_windows_of_few_words(n):
    text = " ".join(f"w{i}" for i in range(n))
    w = of(text)
    for k in (1, 2, 4, 5, 8):
        h, fits = w.windows(k)
        assert len(h) == n and int(fits.sum()) == max(0, n - k + 1)
        assert len(W.shingles(w, k)[0]) == (max(1, n - k + 1) if n else 0)


def test_hashes_tell_words_apart():
    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abé") for _ in range(rnd.randint(1, 40))) for _ in range(5000)]
    pool += ["x" * n for n in range(1, 600)] + [thue_morse(0), thue_morse(1)]
    found = of(" ".join(pool), " ".join(reversed(pool))).hashes
    assert found[:len(pool)].tolist() == found[len(pool):][::-1].tolist()
    assert len(set(found.tolist())) == len(set(pool))


def test_complementary_words_do_not_link(spark):
    rows = [(1, thue_morse(0)), (2, thue_morse(1)), (3, thue_morse(0))]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_short_batches_and_tail_chunks(spark):
    tail = "two words"
    rows = [[(1, " ".join(f"w{i}" for i in range(n)))] for n in (0, 1, 2, 5)] + [[(1, "long " * (CHUNK_BYTES // 4)), (2, tail)]]
    for some in rows:
        docs = spark.createDataFrame(some, "doc_id long, text string").coalesce(1).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
        assert ngram_join.join(docs).count() == len(some)
        assert quality_rules.filter_documents(docs).count() == 0
