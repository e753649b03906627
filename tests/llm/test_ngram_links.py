"""Links between texts and links per document, against all pairs by brute force."""

import random

import pytest

from vigor.llm import ngram_links

SCHEMA = "doc_id long, text string, rep long, bits string"


def _sets(rows, k):
    out = {}
    for d, text, *_ in rows:
        w = (text or "").lower().split()
        out[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    return out


def brute(rows, k, share):
    sets = _sets(rows, k)
    rep = {d: min(e for e in sets if sets[e] == s) if s else None for d, s in sets.items()}
    near = lambda a, b: bool(a & b) and share[1] * len(a & b) >= share[0] * len(a | b)
    linked = {d: [e for e in sets if e != d and near(s, sets[e])] for d, s in sets.items()}
    pairs = {(min(rep[d], rep[e]), max(rep[d], rep[e])) for d, es in linked.items() for e in es if rep[d] != rep[e]}
    return pairs, {d: (rep[d], len(es)) for d, es in linked.items()}


@pytest.mark.parametrize("tile", [1024, 4])
def test_links_of_a_group_of_near_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(ngram_links, "TILE", tile)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):      # one group of near copies: most of its links lie inside a component of stars
        words = list(base)
        for _ in range(rnd.randrange(5)):
            words[rnd.randrange(300)] = f"x{rnd.randrange(9)}"
        rows.append((i, " ".join(words), i, "clash"))
    rows += [(100 + i, " ".join(f"v{rnd.randrange(400)}" for _ in range(30)), None, None) for i in range(20)]
    rows += [(200, None, 1, None), (201, "", 1, None), (202, "one two", 1, None), (203, "ONE two", 1, None), (204, rows[0][1], 1, None)]
    pairs, members = brute(rows, 4, (85, 100))
    docs = spark.createDataFrame([*rows, rows[3], (None, rows[0][1], 1, None)], SCHEMA).repartition(3)
    got = ngram_links.links(docs, k=4, share=(85, 100)).collect()
    assert len(got) == len(pairs) > 100 and {(r["a"], r["b"]) for r in got} == pairs
    rows_got = ngram_links.memberships(docs, k=4, share=(85, 100)).collect()
    assert len(rows_got) == len(members) and {r["doc_id"]: (r["rep"], r["n_links"]) for r in rows_got} == members


def test_links_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_links.links(empty).count() == 0 == ngram_links.memberships(empty).count()
    with pytest.raises(ValueError):
        ngram_links.links(empty, share=(1, 2))
