"""Personal data against plain Python with the patterns as they are stated."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigor.llm import personal_data, registry

STATED = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    odd = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


def sound(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in STATED for m in re.finditer(p, text or "") if sound(k, m.group())]
    n = Counter(k for k, _, _ in spans)
    line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (*(n[k] for k, _ in STATED), hashlib.sha256(line.encode()).hexdigest())


def base(df):
    out = personal_data.find(df, ["doc_id"]).select("doc_id", F.filter("spans", lambda s: s["base"]).alias("base"))
    got = []
    for r in out.collect():
        n = Counter(s["kind"] for s in r["base"])
        line = ",".join(f"{s['kind']}:{s['start']}:{s['stop']}" for s in r["base"])
        got.append((r["doc_id"], (*(n[k] for k, _ in STATED), hashlib.sha256(line.encode()).hexdigest())))
    return got


def test_base_spans(spark):
    rnd = random.Random(11)
    bits = ["a@b.co", "x.y+z@mail-1.example.com", "@", "a@b", ".", "..", "_q@d.org", "1.2.3.4", "256.1.1.1", "10.0.0.255", "0000255.1.2.3", "1.2.3", " ", "-", "--",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "6011000990139424", "4242424242424242 ", "4", "+1 (743) 555-3824", "+12", "+49 30 1234567)", "é", "😀", "\n", "Zürich ", "+", "()", "7 "]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (2002, "9" * 900), (2003, "a" * 900 + "@"), (2004, "a@b.co " * 900), (2005, "4 " * 900),
             (2006, "x@" + "y." * 900 + "z"), (2007, "1." * 900), (2008, "+1" + " " * 900 + "2"), (None, "a@b.co"), (None, "a@b.co"), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("spans", F.lit(1)).repartition(6)
    want = Counter((d, brute(t)) for d, t in rows)
    assert Counter(base(df)) == want
    assert personal_data.find(df.limit(0), ["doc_id"]).count() == 0


def test_very_long_runs(spark):
    texts = ["9" * 300_000, "a" * 300_000 + "@", "a@b.co " * 20_000, "4 " * 100_000, "x@" + "y." * 100_000 + "z", "1." * 100_000, "+1" + " " * 100_000 + "2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = personal_data.find(df, ["doc_id"]).select("doc_id", F.size("spans").alias("n"), F.element_at("spans", -1)["stop"].alias("last")).orderBy("doc_id")
    assert [(r["n"], r["last"]) for r in out.where("n > 0").collect()] == [(20_000, 139_999), (1, 200_003), (25_000, 199_999)]


def kinds(spark, *texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[(s["kind"], s["text"]) for s in r["spans"]] for r in personal_data.find(df, ["doc_id"], **how).orderBy("doc_id").collect()]


def test_checksums_and_context(spark):
    got = kinds(spark, "IBAN DE89 3704 0044 0532 0130 00.", "GB82WEST12345698765432, GB82WEST12345698765433", "my card 378282246310005", "number 378282246310005",
                "card 378282246310006", "Tel: (030) 123-4567 89", "code (030) 123-4567 89", "SSN 123-45-6789", "id 123-45-6789", "ssn 000-45-6789", "Call +1 (743) 555-3824 now",
                "call the desk" + " x" * 40 + " 030 1234567")
    assert got == [[("iban", "DE89 3704 0044 0532 0130 00")], [("iban", "GB82WEST12345698765432")], [("card", "378282246310005")], [], [],
                   [("phone", "(030) 123-4567 89")], [], [("ssn", "123-45-6789")], [], [], [("phone", "+1 (743) 555-3824")], []]
    assert kinds(spark, "a@b.co 030 1234567", threshold=0.15) == [[("email", "a@b.co"), ("phone", "030 1234567")]]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_running(spark, n):
    values = [random.Random(n).randint(0, 9) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<long>")
    before, sums = personal_data.running("v")
    row = row.select("v", F.expr(before).alias("b")).select(F.expr(sums("b")).alias("s")).first()
    total, want = 0, []
    for v in values:
        total += v
        want.append(total)
    assert row["s"] == want


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = personal_data.find(df, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query(spark):
    out = registry.queries()["op12_personal_data"](spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in out.collect()}
    assert got == {d: brute(t) for d, t in texts.items()}
