"""Line and paragraph dedup against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigor.llm import registry, unit_dedup

SEPARATOR = {"sentence": "(\n|(?<=[.!?])[ \t\r]+\n?)", "line": "(\n)", "paragraph": "(\n(?:[ \t\r]*\n)+)"}


def brute(rows, unit, min_bytes):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        parts = re.split(SEPARATOR[unit], t or "") + [""]
        at, spans, kept, found = 0, [], "", 0
        for body, end in zip(parts[::2], parts[1::2], strict=True):
            size, key = len((body + end).encode()), " ".join(re.split(r"[\x20\x09-\x0D]+", body)).strip(" ").encode().lower()
            if key and len(key) >= min_bytes:
                found += 1
                if key in seen:
                    spans.append((at, at + size))
                else:
                    seen.add(key)
            if not spans or spans[-1][1] != at + size:
                kept += body + end
            at += size
        merged = []
        for a, b in spans:
            merged.append((merged.pop()[0], b) if merged and merged[-1][1] == a else (a, b))
        out[d] = (at, sum(b - a for a, b in merged), len(merged), found, len(spans), merged, kept.encode())
    return out


def result(r):
    return (r["n_bytes"], r["n_removed"], r["n_spans"], r["n_units"], r["n_dropped"], [tuple(x) for x in r["spans"]], bytes(r["kept"]))


@pytest.mark.parametrize("unit,min_bytes", [("sentence", 1), ("sentence", 9), ("line", 1), ("paragraph", 1), ("line", 12)])
def test_unit_dedup(spark, unit, min_bytes):
    rnd = random.Random(7)
    pool = ["a line of é", "A  Line of é\t", " a line\tof é", "b", "", " ", "other words here", "OTHER words  here\r", "É", "é",
            "a b. A line of é! ", "b? b.c a  b.\t", "a line of é!\rother words here."]
    rows = [(i, "".join(rnd.choice(pool + [f"own {i}"]) + rnd.choice(["\n", "\n\n", "\n \t\n"]) for _ in range(rnd.randint(0, 9)))
             + rnd.choice(pool)) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "x\n" * 5000), (204, rows[3][1]), (-5, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("key", F.lit(1)).repartition(5)
    got = {r["doc_id"]: result(r) for r in unit_dedup.dedup(df, unit=unit, min_bytes=min_bytes).collect()}
    assert got == brute(rows, unit, min_bytes)
    assert unit_dedup.dedup(df.limit(0), unit=unit).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "same"), (None, "same"), (2, "same\ntwo"), (2, "same\ntwo"), (3, "two\nthree")]
    out = unit_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = Counter((r["doc_id"], bytes(r["kept"])) for r in out.collect())
    assert got == Counter([(None, b"same"), (None, b"same"), (2, b"same\ntwo"), (2, b""), (3, b"three")])


def test_registered():
    assert registry.queries()["op3_unit_dedup"] is unit_dedup.query
