"""Text operators against brute force on fixtures with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigor.llm import byte_bpe, id_files, line_dedup, mixing, ngram_join, quality_rules, suffix_dedup
from vigor.llm.suffix_order import suffix_order

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(n=120, seed=3):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    sentence = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    shared = [sentence(14) for _ in range(4)]
    texts = []
    for i in range(n):
        lines = [sentence(rnd.randint(3, 40)) for _ in range(rnd.randint(1, 6))]
        if rnd.random() < 0.5:
            lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(shared) + rnd.choice(["", " ", "\t"]))
        if texts and rnd.random() < 0.3:
            words = rnd.choice(texts).split(" ")
            words[rnd.randrange(len(words))] = "changed"
            lines = [" ".join(words)]
        texts.append("\n".join(lines))
    texts += ["", None, "one", "two words", " \t\n ", texts[0], texts[0], "ab" * 4000, "x " * 3000, shared[0].upper()]
    return [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- suffix dedup -------------------------------------------------------------------------------------------------

def test_suffix_order_is_the_sorted_order():
    rnd = random.Random(5)
    for _ in range(800):
        s = bytes(rnd.randrange(rnd.choice([1, 2, 3, 200])) for _ in range(rnd.randint(0, 40))) * rnd.choice([1, 1, 3])
        assert suffix_order(np.frombuffer(s, np.uint8)) == sorted(range(len(s)), key=lambda i: s[i:])


def brute_substrings(rows, window=50):
    seen, out = {}, {}
    for d, t, *_ in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - window + 1):
            if seen.setdefault(raw[s:s + window], d) < d:
                gone[s:s + window] = b"\1" * window
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), kept)
    return out


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])  # with 1 every open anchor is dealt to several tasks
def test_suffix_dedup(docs, rows, empty, group):
    got = by_id(suffix_dedup.dedup(docs, group=group))
    for d, want in brute_substrings(rows).items():
        r = got[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want
    if group > 1:
        assert suffix_dedup.dedup(empty).count() == 0


def test_suffix_dedup_null_and_repeated_ids(spark):
    a, b = "q" * 60 + "abc", "r" * 60
    out = suffix_dedup.dedup(spark.createDataFrame([(None, a), (1, a), (2, a), (2, b), (2, b), (3, b + "z")], "doc_id long, text string"))
    got = Counter((r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in out.collect())
    assert got == Counter([(None, 0, a.encode()), (1, 0, a.encode()), (2, 63, b""), (2, 0, b.encode()), (2, 0, b.encode()), (3, 60, b"z")])


# -- mixing -------------------------------------------------------------------------------------------------------

def test_mixing_targets_and_copies(spark, docs, rows, empty):
    got = by_id(mixing.mix(docs))
    size = {d: len(WORD.findall(t or "")) for d, t, *_ in rows}
    source = {d: s for d, _, _, s, _ in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    total, cap = sum(size.values()), {}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    for s in names:
        cap[s] = 3 * sum(n for d, n in size.items() if source[d] == s)
    full = set()
    while True:
        level = (total - sum(cap[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > cap[s]}
        if not more:
            break
        full |= more
    for d, r in got.items():
        s = source[d]
        assert r["size"] == size[d] and r["source_size"] == cap[s] / 3
        assert r["target"] == pytest.approx(cap[s] if s in full else weight[s] * level)
        assert r["taken"] == r["copies"] * size[d] <= 3 * size[d]
    for s in names:
        mine = [r for d, r in got.items() if source[d] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)
    assert by_id(mixing.mix(docs.repartition(3))) == got
    clash = docs.withColumn("size", F.lit("mine")).withColumn("copies", F.lit(-1))
    out = mixing.repeated(clash)
    assert out.columns == clash.columns and out.count() == sum(r["copies"] for r in got.values())
    assert {(r["size"], r["copies"]) for r in out.collect()} == {("mine", -1)}
    assert mixing.mix(empty).count() == 0


def test_mixing_spreads_rows_without_doc_id(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(None, "same five words of text", "en", "a")] * 200 + [(None, f"word {i} of five words", "en", "a") for i in range(100)]
    rows += [(i, "three more words " * 2, "en", "b") for i in range(300)]
    out = mixing.mix(spark.createDataFrame(rows, schema).repartition(4), weights=(1, 3))
    sums = {r["source"]: r for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()}
    assert all(abs(r["taken"] - r["target"]) <= 12 and r["n"] == 300 for r in sums.values()), sums
    again = mixing.mix(spark.createDataFrame(rows, schema).repartition(7), weights=(1, 3))
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))


def test_mixing_stays_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# -- n-gram join --------------------------------------------------------------------------------------------------

def brute_components(rows, k, share):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t, *_ in rows:
        w = WORD.findall((t or "").translate(low))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and share[1] * both >= share[0] * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("k,share,tile", [(4, (85, 100), 4096), (5, (80, 100), 4096), (2, (60, 100), 3)])
def test_ngram_join(docs, rows, monkeypatch, k, share, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)  # small tiles: every list is cut into several
    got = by_id(ngram_join.join(docs, k=k, share=share))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == brute_components(rows, k, share)


def test_ngram_join_edges(spark, empty):
    assert ngram_join.join(empty).count() == 0
    same = "a b c d e f g h"
    out = ngram_join.join(spark.createDataFrame([(None, same), (5, same), (4, same), (4, same), (9, None)], "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in out.collect()) == [(0, 4), (4, 4), (4, 4), (5, 4), (9, 9)]


# -- tokenizers ---------------------------------------------------------------------------------------------------

ODD = ["", None, "<|endoftext|>a <|endoftext|>", "don't 'S  \n\n x", "  ", "́combining é", "漢字 \U0001f600 \x1c\x85", "=" * 500,
       "a" * 3000, "<|ENDOFTEXT|> <|startoftext|>B", "Σσς İ"]


def test_byte_bpe(spark, docs, rows, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(byte_bpe.default_path())
    texts = [r[1] for r in rows] + ODD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = by_id(byte_bpe.encode_decode(df))
    for d, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[d]["ids"]), "<u4").tolist() == ids
        assert got[d]["decoded"] == t.decode(ids, skip_special_tokens=False)
    digest = by_id(byte_bpe.digests(docs))[0]
    assert digest["ids_sha256"] == hashlib.sha256(bytes(got[0]["ids"])).hexdigest()
    assert byte_bpe.encode_decode(empty).count() == 0


def test_id_files(spark, tmp_path, rows, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(id_files.default_path())
    texts = [r[1] for r in rows] + ODD
    ids = [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    target = str(tmp_path / "ids")
    id_files.blocks(df, block_ids=500).write.parquet(target)
    got = by_id(id_files.read(spark, target).join(id_files.block_starts(spark, target), ["shard", "block"]))
    start = 0
    for d, want in enumerate(ids):
        assert np.frombuffer(bytes(got[d]["ids"]), "<u4").tolist() == want
        assert got[d]["block_start"] + got[d]["start_in_block"] == start
        start += len(want)
    many = [*range(-5000, 15_000)]
    assert by_id(id_files.read(spark, target, many)).keys() == {d for d in by_id(id_files.read(spark, target)) if d is not None}
    assert id_files.ranges([1, 2, 9, 10, 50], 2) == [(1, 10), (50, 50)] and id_files.ranges([]) == []
    few = by_id(id_files.read(spark, target, [3, 60]))
    assert sorted(few) == [3, 60] and np.frombuffer(bytes(few[60]["ids"]), "<u4").tolist() == ids[60]
    raw = np.array(ids[3], "<u4").tobytes()
    assert zlib.crc32(raw) == id_files.read(spark, target, [3]).select(F.crc32("ids")).first()[0]
    id_files.write(empty, str(tmp_path / "none"))
    assert id_files.read(spark, str(tmp_path / "none")).count() == 0


def test_bit_packing():
    rnd = np.random.default_rng(1)
    for bits in (1, 3, 8, 12, 16, 17, 25):
        for n in (0, 1, 7, 8, 9, 100):
            a = rnd.integers(0, 1 << bits, n).astype(np.uint32)
            raw = id_files.pack(a, bits)
            assert (id_files.unpack(raw, bits, 0, n) == a).all()
            assert all((id_files.unpack(raw, bits, i, min(n, i + 3)) == a[i:i + 3]).all() for i in range(n))


# -- quality rules ------------------------------------------------------------------------------------------------

def brute_counts(t):
    t, seen, dup = t or "", set(), 0
    w = WORD.findall(t)
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(covered)


def test_quality_rules(spark, docs, rows, empty):
    base = [(1000 + i, " ".join(f"wort{j}x{i}" for j in range(60 + i)), "en", "s", 1) for i in range(40)]
    junk = [(2000, "na### " * 5 + " ".join(f"ab{j}###" for j in range(60)), "en", "s", 1),
            (2001, " ".join(f"w{j} w{j}" for j in range(40)), "en", "s", 1), (2002, "zu kurz", "en", "s", 1)]
    more = spark.createDataFrame(base + junk, SCHEMA).unionByName(docs)
    measured = quality_rules.measure(more, ["doc_id", "lang", "source"])
    texts = {r[0]: r[1] for r in base + junk + rows}
    fences = quality_rules.thresholds(quality_rules.sketches(measured))
    got = by_id(quality_rules.verdicts(measured, fences))
    for d, t in texts.items():
        r, want = got[d], brute_counts(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert all(got[d]["kept"] for d, *_ in base) and not any(got[d]["kept"] for d, *_ in junk)
    clash = more.withColumn("n_words", F.lit("mine"))
    kept = quality_rules.filter_documents(clash)
    assert kept.columns == clash.columns and {r["n_words"] for r in kept.collect()} == {"mine"}
    assert kept.count() == sum(r["kept"] for r in got.values())
    assert quality_rules.filter_documents(empty).count() == 0


def test_sketches_merge(docs):
    measured = quality_rules.measure(docs, ["doc_id", "lang", "source"])
    halves = [quality_rules.sketches(measured.filter(F.col("doc_id") % 2 == i)) for i in (0, 1)]
    order = lambda df: sorted(map(str, df.collect()))
    assert order(quality_rules.thresholds(halves[0].unionByName(halves[1]))) == order(
        quality_rules.thresholds(quality_rules.sketches(measured)))


# -- line dedup ---------------------------------------------------------------------------------------------------

def brute_lines(rows, min_chars, min_docs):
    keys = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            keys.setdefault(key(line), set()).add(d)
    out = {}
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(k := key(x)) < min_chars or len(keys[k]) < min_docs or d == max(keys[k])]
        out[d] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def test_line_dedup(spark, docs, rows, empty):
    got = by_id(line_dedup.dedup(docs))
    for d, want in brute_lines(rows, 40, 5).items():
        assert (got[d]["n_lines"], got[d]["n_dropped"], got[d]["text"] or "") == want
    assert any(r["n_dropped"] for r in got.values())
    clash = docs.withColumn("n_lines", F.lit("mine")).withColumn("key", F.lit(1))
    out = line_dedup.cleaned(clash)
    assert out.columns == clash.columns and all(r["n_chars"] == len(r["text"] or "") or r["text"] is None for r in out.collect())
    assert line_dedup.dedup(empty).count() == 0
    assert line_dedup.cleaned(spark.createDataFrame([(None, "x" * 50)] * 6, "doc_id long, text string")).filter("text = ''").count() == 0


def test_line_index_is_reversible(spark, tmp_path, docs):
    index = line_dedup.LineIndex(spark, str(tmp_path / "lines"))
    order = lambda df: sorted((r["doc_id"], sorted(map(bytes, r["keys"]))) for r in df.collect())
    index.insert(docs.filter("doc_id < 60"))
    before = order(index.losses())
    index.insert(docs.filter("doc_id >= 60"))
    full = line_dedup.references(docs)
    assert order(index.losses()) == order(line_dedup.losses(full, line_dedup.reference_counts(full)))
    index.delete(docs.filter("doc_id >= 60"))
    assert order(index.losses()) == before


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2 ** 63, (20_000, 2)).astype(np.uint64)
    other = rng.integers(0, 2 ** 63, (20_000, 2)).astype(np.uint64)
    made = line_dedup.build(keys)
    assert made.contains(keys).all() and made.contains(other).mean() < 0.01
    made.delete(keys[:5000])
    assert made.contains(keys[5000:]).all() and made.contains(keys[:5000]).mean() < 0.01
    assert line_dedup.Cuckoo.of(made.raw()).contains(keys[5000:]).all()
