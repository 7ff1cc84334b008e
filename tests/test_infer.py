import pytest
from pyspark.sql import functions as F

from rowsmith.operators.clean import clean
from rowsmith.operators.infer import draft_spec, infer_columns
from rowsmith.spec import CategoryField, DateYear, NumericField, TargetField


def raw_table(spark, n=200):
    rows = [
        (
            str(i), str(i * 3 - 7) if i % 50 else "n/k", str(10**12 + i), f"{i / 4}" if i % 9 else None, f"{i % 12 + 1}/{i % 28 + 1}/9{i % 10}",
            ("red", "blue", ".", " ")[i % 4], f"note {i}", None, ("yes", "no")[i % 2],
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id string, amount string, serial string, `a size` string, day string, colour string, note string, nothing string, ok string")


def test_types(spark):
    got = {r["column"]: r for r in infer_columns(raw_table(spark)).collect()}
    assert {c: r["type"] for c, r in got.items()} == {
        "id": "integer", "amount": "integer", "serial": "long", "a size": "double", "day": "date", "colour": "category",
        "note": "text", "nothing": "empty", "ok": "category",
    }
    assert got["day"]["date_format"] == "M/d/yy" and got["colour"]["vocabulary"] == [" ", ".", "blue", "red"]
    assert (got["amount"]["n"], got["amount"]["n_integer"], got["amount"]["low"], got["amount"]["high"]) == (200, 196, -4.0, 590.0)
    strict = {r["column"]: r["type"] for r in infer_columns(raw_table(spark), share=1.0).collect()}
    assert strict["amount"] == "text" and strict["id"] == "integer"


def test_vocabulary_bound(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("v"), F.col("id") % 51).alias("many"), F.concat(F.lit("w"), F.col("id") % 50).alias("few"), F.concat(F.lit("x"), "id").alias("all"))
    got = {r["column"]: r for r in infer_columns(rows.repartition(7)).collect()}
    assert (got["many"]["type"], got["few"]["type"], got["all"]["type"]) == ("text", "category", "text")
    assert len(got["few"]["vocabulary"]) == 50
    with pytest.raises(ValueError, match="max_vocabulary"):
        infer_columns(rows, max_vocabulary=0)


def test_empty_table(spark):
    got = infer_columns(raw_table(spark).limit(0)).collect()
    assert {r["type"] for r in got} == {"empty"} and len(got) == 9
    with pytest.raises(ValueError, match="no columns"):
        infer_columns(spark.range(1).select())


def test_one_scan(spark, tmp_path):
    raw_table(spark).write.option("header", True).csv(str(tmp_path / "raw"))
    plan = infer_columns(spark.read.option("header", True).csv(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("FileScan csv") == 1


def test_draft(spark):
    raw = raw_table(spark)
    spec = draft_spec(raw, key=("id",), target="ok")
    assert spec.key_type == "bigint" and spec.target == TargetField("ok", ("no", "yes"))
    assert spec.numeric == (NumericField("amount", "int"), NumericField("serial", "bigint"), NumericField("a size", "double"), NumericField("day_year", "int"))
    assert spec.categorical == (CategoryField("colour", ("blue", "red"), (".",), True),)
    assert spec.date_year == DateYear("day", "day_year", ("M/d/yy",))
    kept = clean(raw, spec, mode="drop")
    assert kept.count() == 196 and kept.where("colour IS NULL").count() > 0
    with pytest.raises(ValueError, match="not in the table"):
        draft_spec(raw, key=("id",), target="other")
    with pytest.raises(ValueError, match="no category"):
        draft_spec(raw, key=("id",), target="note")
