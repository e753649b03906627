"""Fences of groups that can't set their own: few documents, or largely junk."""

from vigor.llm import quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def clean(i, extra=""):
    return " ".join(f"{'abcdefg'[(i + j) % 7]}ord{j}{extra}" for j in range(60 + i % 30))


def junk(i):
    return " ".join(f"ab{j}x{i}##" for j in range(60 + i % 30))


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, lang, source, 1) for i, (t, lang, source) in enumerate(rows)], SCHEMA).repartition(3)
    measured = quality_rules.measure(df, ["doc_id", "lang", "source"])
    out = quality_rules.verdicts(measured, quality_rules.thresholds(quality_rules.sketches(measured)))
    assert quality_rules.filter_documents(df).count() == out.filter("kept").count()
    return {r["doc_id"] for r in out.filter("kept").collect()}


def test_small_and_junk_groups(spark):
    good = [(clean(i), "en", f"s{i % 3}") for i in range(90)] + [(clean(i), "de", "s0") for i in range(30)]
    good += [(clean(i), "en", "two") for i in range(1)] + [(clean(i), "en", "half") for i in range(30)] + [(clean(i), "de", "most") for i in range(5)]
    bad = [(junk(1), "en", "two")] + [(junk(i), "en", "half") for i in range(30)] + [(junk(i), "de", "most") for i in range(20)]
    bad += [(junk(i), "de", f"lone{i}") for i in range(2)]
    assert kept(spark, good + bad) == set(range(len(good)))


def test_what_differs_by_language_stays(spark):
    """Long words are no junk in a language that has them, and a source with somewhat more symbols keeps its documents."""
    rows = [(clean(i), "en", f"s{i % 2}") for i in range(80)] + [(clean(i, "donaudampfschifffahrt"), "xx", f"s{i % 2}") for i in range(12)]
    rows += [(clean(i) + " #" * 8, "en", "code") for i in range(40)]
    assert kept(spark, rows) == set(range(len(rows)))
