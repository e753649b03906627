"""Pages, vectors and the pipeline against brute force."""

import math
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

from vigor import session
from vigor.llm import components, html_text, line_dedup, mixing, ngram_join, quality_rules, top_k
from vigor.llm.html_text import common_lines, parse

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def text_of(source):
    return " ".join(x for x, inside in parse(source).lines if inside)


def test_page_structure():
    assert text_of('<div class="cookie-banner">x</div><header>Top</header><main><header><h1>T &amp; U</h1></header><p>a<b>b</b> c'
                   '<script>var a="</p>";</script>d<div id="comments"><p>no</p></div><p>z &lt; y') == "T & U ab cd z < y"
    assert text_of('<nav>n</nav><article><p>one&nbsp;two<br>three<aside>s</aside></p><form>f</form>four</article><footer>f</footer>') == "one two three four"
    assert text_of('<article><!-- <p>no</p> --><p title="a > b">yes</p><div class="advert">ad</div></article>') == "yes"
    assert parse(None).lines == [] == parse("").lines


def test_common_lines_are_a_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(1500):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 8))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        common = [a[i] for i in sorted(common_lines(a, b))]
        rest = iter(b)
        assert len(common) == best[-1][-1] and all(x in rest for x in common)


def test_extract(spark):
    plain = "<body><div>Menu of host</div><p>{}</p><div>All rights</div></body>"
    rows = [(1, "http://h.x/a/1", plain.format("first text")), (2, "http://h.x/a/2?q", plain.format("second text")),
            (3, "http://h.x/a/3", "<article>third</article><div>Menu of host</div>"), (4, "http://other.x/", plain.format("alone")),
            (5, None, None), (6, "no url", ""), (6, "no url", "")]
    rows += [(100 + i, f"http://hot.x/p/{i:04d}", plain.format(f"text {i}")) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [(r["page_id"], r["text"]) for r in html_text.extract(df).collect()]
    want = [(1, "first text"), (2, "second text"), (3, "third"), (4, "Menu of host alone All rights"), (5, ""), (6, ""), (6, "")]
    assert sorted(got) == sorted(want + [(100 + i, f"text {i}") for i in range(200)])
    assert html_text.extract(df.limit(0)).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK", 16)
    monkeypatch.setattr(top_k, "LOT", 3)
    monkeypatch.setattr(top_k, "TILE", 7)
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(30)]  # ties
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (None, [1.0] * 6), (700, []), (750, [2.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    ints = top_k.as_integers(df)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k.search(ints.filter("vec_id % 50 = 0"), ints).collect()}
    sound = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = {}
    for q in sound:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(sound[q], v, strict=False)), i) for i, v in sound.items() if i != q)[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert top_k.search(ints.limit(0), ints.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [
        (rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(500)]
    line = "this very line is found in a good many of the documents here"
    rows = []
    for i in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(60, 150))]
        rows.append((i, " ".join(words) + ("\n" + line if i % 2 else ""), "en", f"s{i % 3}", 0))
    rows += [(100 + i, rows[i][1], "en", "s0", 0) for i in range(5)] + [(200, "too short", "en", "s1", 0), (201, None, None, None, None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path), rows, line


def test_pipeline(spark, tables):
    import corpus_pipeline
    path, rows, line = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, path)
        assert docs.dtypes == before.dtypes
        docs = docs.cache()
        kept[name] = sorted(docs.collect(), key=lambda r: r["doc_id"])
    good = {i for i, *_ in rows} - {200, 201}
    assert {r["doc_id"] for r in kept["quality rules"]} == good
    lines = kept["line dedup"]
    assert {r["doc_id"] for r in lines} == good
    assert [r["doc_id"] for r in lines if line in r["text"]] == [103]  # the largest that holds it
    assert {r["doc_id"] for r in kept["n-gram Jaccard join"]} == set(range(60))
    copies = kept["mixing sources to target weights"]
    assert {r["doc_id"] for r in copies} <= set(range(60))
    out = corpus_pipeline.run(spark, path)
    assert sorted(r["doc_id"] for r in out.collect()) == [r["doc_id"] for r in copies]
    none = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, path)
    assert none.count() == 0


def test_few_rows_go_to_few_files(spark, tables):
    path, *_ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    folder = f"{session.ensure_checkpoint_dir(spark).rstrip('/').removeprefix('file:')}/llm"
    old = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ngram_join.join(docs).collect()
        quality_rules.filter_documents(docs).collect()
        mixing.mix(docs).collect()
        line_dedup.dedup(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d.rsplit("-", 1)[0]: sum(x.endswith(".parquet") for x in os.listdir(f"{folder}/{d}")) for d in set(os.listdir(folder)) - old}
    few = {"classes", "members", "near", "ids", "links", "edges", "stars", "first", "candidates", "fences", "frequent", "buckets", "cuts"}
    assert few <= set(files) and {d: files[d] for d in few} == dict.fromkeys(few, 1)


def test_text_crosses_to_python_once(spark, tables):
    path, *_ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("kept", F.lit("clash"))
    out = quality_rules.filter_documents(docs)
    assert out.columns == docs.columns and out.filter("kept = 'clash'").exceptAll(docs).count() == 0 < out.count()
    assert "text, text#" not in out._jdf.queryExecution().optimizedPlan().toString()
