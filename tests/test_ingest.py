"""CSV inference, sheet loads and row comparison."""

from pyspark.sql import functions as F

from vigor.operators import sinks as S
from vigor.sources import ingest as I


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_inferred_types_and_broken_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,x,day,t\n1,1.5,2024-01-02,a\n2,,2024-01-03,\"b,c\"\nonly one\n")
    (tmp_path / "in" / "b.csv").write_text("id,x,day,t\n3,2,2024-01-04,\n4,5,2024-01-05,d,too many\n")
    rows, broken = I.read_csv_inferred(spark, str(tmp_path / "in"), str(tmp_path / "lines"))
    assert dict(rows.dtypes) == {"id": "bigint", "x": "double", "day": "date", "t": "string"}
    assert sorted(r.t or "" for r in rows.collect()) == ["", "a", "b,c"]
    assert sorted(r[0] for r in broken.collect()) == ["4,5,2024-01-05,d,too many", "only one"]


def test_sheets_skip_empty_sources(spark, tmp_path):
    sheet = spark.createDataFrame([("1", "1.0", "x"), (" 2", "", "nan"), (None, "2.5", "y")], "a string, b string, c string")
    base = str(tmp_path)
    assert I.ingest_sheets({"one": sheet, "none": sheet.limit(0)}, base) == ["one"]
    one = S.read_table(spark, f"{base}/one")
    assert one.dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    assert _rows(one) == sorted([(1, 1.0, "x"), (2, None, None), (None, 2.5, "y")], key=repr)
    assert S.read_table(spark, f"{base}/none") is None


def test_row_changes(spark):
    schema = "k long, a string, b double"
    loaded = spark.createDataFrame([(1, "x", 1.0), (2, "x", None), (3, None, 3.0), (None, "n", 0.0), (5, "gone", 5.0)], schema)
    incoming = spark.createDataFrame([(1, "x", 1.0), (2, "x", 2.0), (3, "", 3.0), (None, "n", 0.0), (4, "new", 4.0)], schema)
    got = _rows(I.row_changes(incoming.withColumn("c", F.lit(1)), loaded.withColumn("c", F.lit(1)), ["k"]).select("k", "a", "b", "change"))
    assert got == sorted([(1, "x", 1.0, "equal"), (2, "x", 2.0, "changed"), (3, "", 3.0, "changed"), (None, "n", 0.0, "equal"),
                          (4, "new", 4.0, "inserted"), (5, None, None, "vanished")], key=repr)


def test_types_are_those_of_all_rows(spark, monkeypatch):
    """Values after the first rows count as well; of what the first rows leave, one type a column is tested on all rows."""
    monkeypatch.setattr(I, "LOOKED_AT", 3)
    rows = [("1", "1", "2024-01-01", "1", None, "x", None), ("2", "2", "2024-01-02", "2", None, "y", None),
            ("3", "3", "2024-01-03", "3", None, "z", "7"), ("4", "4.5", "2024-01-04", "no", None, "1", "8")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string").coalesce(1)
    asked = []
    fitting = I._fitting
    monkeypatch.setattr(I, "_fitting", lambda df, types: asked.append({c: t[0] for c, t in types.items() if t}) or fitting(df, types))
    assert I.inferred_types(df) == {"a": "bigint", "b": "double", "c": "date", "d": "string", "e": "string", "f": "string", "g": "bigint"}
    assert asked[0] == {"a": "bigint", "b": "bigint", "c": "date", "d": "bigint", "e": "bigint", "g": "bigint"}
    assert "a" not in asked[1] and "f" not in asked[1]
    assert I.inferred_types(df.limit(0)) == dict.fromkeys("abcdefg", "string")


def test_numbers_of_any_spelling_are_numeric(spark):
    df = spark.createDataFrame([(" 1", "Infinity", "F"), ("\t-2.0", "nan", ""), ("+.5e1", "-inf", "1d")], "a string, b string, c string")
    got = {r.column_name: (r.n_values, r.n_numeric, r.decided_type) for r in I.narrowing_decisions(df).collect()}
    assert got["a"] == (3, 3, "bigint") and got["b"][:2] == (2, 2) and got["c"][2] == "string"
