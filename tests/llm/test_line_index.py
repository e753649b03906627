"""Deletions from the line index."""

import numpy as np

from vigor.llm import line_dedup


def test_delete_takes_retried_inserts_too(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a line that is certainly long enough to count here") for i in range(6)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "lines"))
    index.insert(docs)
    index.insert(docs.filter("doc_id >= 3"))
    index.delete(docs.filter("doc_id >= 3"))
    assert sorted(r["doc_id"] for r in index.references().collect()) == [0, 1, 2]
    index.delete(docs.filter("doc_id >= 3"))
    index.insert(docs.filter("doc_id = 4"))
    assert sorted(r["doc_id"] for r in index.references().collect()) == [0, 1, 2, 4]


def _lost(df):
    return sorted((r["doc_id"], sorted(map(bytes, r["keys"]))) for r in df.collect())


def _filter_keys(index):
    """What the stored filters say of every key that was ever seen."""
    seen = [bytes(r["key"]) for r in index._read("refs").select("key").distinct().collect()]
    shards = index._shards()
    made = {r["shard"]: line_dedup.Cuckoo.of(bytes(r["filter"])) for r in index._filters(shards).collect()}
    at = {bytes(r["key"]): r["s"] for r in index._read("refs").select("key", line_dedup._shard(shards).alias("s")).distinct().collect()}
    return {k for k in seen if at[k] in made and made[at[k]].contains(line_dedup.as_words([k]))[0]}


def test_filters_follow_the_counts(spark, tmp_path):
    line = lambda n: f"line number {n:05d} is long enough to be counted by the index"
    docs = spark.createDataFrame([(d, "\n".join(line(n) for n in range(40) if n % (d + 1) < 3)) for d in range(12)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "lines"), min_docs=3, shard_keys=8)
    assert _lost(index.losses()) == []
    parts = [("insert", "doc_id < 2"), ("insert", "doc_id < 7"), ("insert", "doc_id >= 7"), ("delete", "doc_id in (1, 5, 11)"),
             ("insert", "doc_id = 5"), ("delete", "doc_id >= 2")]
    live, shards = set(), []
    for how, where in parts:
        getattr(index, how)(docs.filter(where))
        ids = {r["doc_id"] for r in docs.filter(where).collect()}
        live = live | ids if how == "insert" else live - ids
        refs = line_dedup.references(docs.filter(docs["doc_id"].isin(*live)))
        counts = line_dedup.reference_counts(refs)
        assert _lost(index.losses()) == _lost(line_dedup.losses(refs, counts, 3))
        shards.append(index._shards())
        if shards[-1]:
            frequent = {bytes(r["key"]) for r in counts.filter("n_docs >= 3").collect()}
            held = _filter_keys(index)
            assert frequent <= held and len(held - frequent) <= 1   # a 16-bit fingerprint may be another key's
    assert shards[0] == 0 and 1 < shards[1] and shards[-1] == shards[-2]   # deletions keep the filters and empty them


def test_change_without_filters_does_not_count(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a line that is certainly long enough to count here") for i in range(6)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "lines"))
    index.insert(docs)
    before = _lost(index.losses())
    index._write(line_dedup.references(docs).selectExpr("key", "doc_id", "-1 AS sign"), "refs", 2)   # the run ends here
    assert _lost(index.losses()) == before and len(before) == 5
    index.delete(docs.filter("doc_id = 5"))
    assert [d for d, _ in _lost(index.losses())] == [0, 1, 2, 3]


def test_a_full_filter_is_built_anew():
    keys = np.random.default_rng(1).integers(0, 2 ** 63, (40, 2)).astype(np.uint64)
    made = line_dedup.build(keys[:20])
    try:
        made.insert(np.concatenate([keys[20:]] * 9))
    except ValueError:
        return
    raise AssertionError("the filter holds more than its slots")
