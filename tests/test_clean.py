import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from rowsmith.functions.expressions import tokens_to_null, year_from_text
from rowsmith.operators import clean as C
from rowsmith.operators import profile as P
from rowsmith.presets import BIRD_SURVEY
from rowsmith.sources.files import read_csv, write_csv
from rowsmith.spec import DateYear, NumericField, TableSpec

RAW = (
    "row_id bigint, `Culmen Length (mm)` string, `Culmen Depth (mm)` string, `Flipper Length (mm)` string, "
    "`Body Mass (g)` string, Island string, Sex string, Species string, `Date Egg` string, Comments string"
)
ADELIE = "Adelie (Pygoscelis adeliae)"
RAW_ROWS = [
    (1, "39.1", "18.7", "181", "3750", "Torgersen", "MALE", ADELIE, "11/11/07", "x"),
    (2, "39.5", "17.4", "186", "3800", "Torgersen", "FEMALE", ADELIE, "11/11/07", None),
    (3, "40.3", "18.0", "195", "3250", "Torgersen", "FEMALE", ADELIE, "11/16/07", None),
    (4, None, None, None, None, "Torgersen", None, ADELIE, "11/16/07", None),
    (5, "36.7", "19.3", "193", "3450", "Torgersen", "FEMALE", ADELIE, "11/16/07", None),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW)


def flags(spark, **cells):
    """Broken rules of one otherwise good row."""
    good = {"row_id": 1, "bill_length_mm": 40.0, "body_mass_g": 4000.0, "year": 2008, "island": "Dream", "sex": "MALE", "species": "Gentoo"}
    row = {**good, **cells}
    schema = "row_id bigint, bill_length_mm double, body_mass_g double, year int, island string, sex string, species string"
    out = C.canonicalise(spark.createDataFrame([tuple(row.values())], schema), BIRD_SURVEY).first()
    return out, [f"{v['field']}:{v['rule']}" for v in out["violations"]]


def test_raw_rows_become_clean_rows(raw):
    out = C.clean(raw, BIRD_SURVEY).orderBy("row_id")
    assert out.columns == ["row_id", *BIRD_SURVEY.columns]
    rows = out.collect()
    assert [r["year"] for r in rows] == [2007] * 5
    assert {r["species"] for r in rows} == {"Adelie"}
    assert rows[0]["bill_length_mm"] == 39.1
    assert rows[3]["body_mass_g"] is None


def test_missing_columns_stay_missing(spark):
    df = spark.createDataFrame([(1, 39.1, 18.7, "Adelie")], "row_id int, bill_length_mm double, bill_depth_mm double, species string")
    assert C.clean(df, BIRD_SURVEY).columns == ["row_id", "bill_length_mm", "bill_depth_mm", "species"]


@pytest.mark.parametrize(
    ("cells", "broken"),
    [
        ({"island": "InvalidIsland"}, ["island:vocabulary"]),
        ({"island": ""}, ["island:vocabulary"]),
        ({"sex": "UNKNOWN"}, ["sex:vocabulary"]),
        ({"sex": "MALE "}, ["sex:vocabulary"]),
        ({"sex": "male"}, ["sex:vocabulary"]),
        ({"species": "InvalidSpecies"}, ["species:vocabulary"]),
        ({"species": ""}, ["species:vocabulary"]),
        ({"bill_length_mm": -10.0, "body_mass_g": -100.0}, ["bill_length_mm:range", "body_mass_g:range"]),
        ({"year": 2020}, ["year:range"]),
        ({"year": 2000}, ["year:range"]),
        ({"year": None, "island": None, "sex": None, "species": None, "bill_length_mm": None}, []),
        ({"bill_length_mm": float("nan")}, []),
        ({"bill_length_mm": 0.0, "year": 2007}, []),
    ],
)
def test_rules(spark, cells, broken):
    assert flags(spark, **cells)[1] == broken


@pytest.mark.parametrize("token", [".", "", "  ", "\t"])
def test_null_tokens(spark, token):
    row, broken = flags(spark, sex=token)
    assert row["sex"] is None and broken == []


@pytest.mark.parametrize(
    ("text", "label"),
    [
        (ADELIE, "Adelie"),
        ("The Chinstrap (Pygoscelis antarctica)", "Chinstrap"),
        ("Gentoo or Adelie", "Adelie"),
        (None, None),
    ],
)
def test_first_listed_label_wins(spark, text, label):
    assert flags(spark, species=text)[0]["species"] == label


def test_text_numbers(spark):
    df = spark.createDataFrame(
        [(1, " 39.5 ", "2007"), (2, "abc", "2007.5"), (3, "NaN", "2008.0"), (4, None, None)],
        "row_id int, bill_length_mm string, year string",
    )
    rows = C.canonicalise(df, BIRD_SURVEY).orderBy("row_id").collect()
    assert [(r["bill_length_mm"], r["year"]) for r in rows] == [(39.5, 2007), (None, 2007), (None, 2008), (None, None)]
    assert [[(v["field"], v["rule"], v["value"]) for v in r["violations"]] for r in rows] == [
        [],
        [("bill_length_mm", "type", "abc"), ("year", "type", "2007.5")],
        [],
        [],
    ]


def test_year_is_derived_only_when_absent(spark):
    df = spark.createDataFrame([(1, "11/11/07", 2009)], "row_id int, date_egg string, year int")
    assert C.clean(df, BIRD_SURVEY).first()["year"] == 2009


def test_two_digit_years_and_junk(spark):
    df = spark.createDataFrame([("11/11/07",), ("1/2/68",), ("1/2/69",), ("12/31/99",), ("soon",), (None,)], "d string")
    years = [r[0] for r in df.select(year_from_text(F.col("d"), ("M/d/yy",))).collect()]
    assert years == [2007, 2068, 1969, 1999, None, None]


def test_several_date_formats(spark):
    df = spark.createDataFrame([("2008-03-01",), ("3/1/09",)], "d string")
    assert [r[0] for r in df.select(year_from_text(F.col("d"), ("M/d/yy", "yyyy-MM-dd"))).collect()] == [2009, 2008][::-1]


def test_strict_mode_fails_and_names_the_rule(spark):
    df = spark.createDataFrame([(1, 2007), (2, 1999)], "row_id int, year int")
    with pytest.raises(PySparkException, match="year"):
        C.clean(df, BIRD_SURVEY).collect()
    assert C.clean(df, BIRD_SURVEY, "drop").count() == 1
    with pytest.raises(ValueError, match="unknown mode"):
        C.clean(df, BIRD_SURVEY, "maybe")


def test_quarantine_covers_all_rows(spark):
    df = spark.createDataFrame([(1, 2007), (2, 1999), (3, None)], "row_id int, year int")
    good, bad = C.quarantine(df, BIRD_SURVEY)
    assert {r["row_id"] for r in good.collect()} == {1, 3}
    assert [r["violations"][0]["value"] for r in bad.collect()] == ["1999"]


def test_verdict_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, 2007), (2, 1999)], "row_id int, year int")
    C.write_by_verdict(C.canonicalise(df, BIRD_SURVEY), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["row_id"], r["verdict"]) for r in back.collect()} == {(1, "valid"), (2, "rejected")}


def test_csv_round_trip_and_missing_texts(spark, raw, tmp_path):
    write_csv(C.clean(raw, BIRD_SURVEY), str(tmp_path / "deep" / "clean"))
    back = C.clean(read_csv(spark, str(tmp_path / "deep" / "clean")), BIRD_SURVEY)
    typed = C.clean(raw, BIRD_SURVEY).select(F.col("row_id").cast("string"), *BIRD_SURVEY.columns)
    assert sorted(map(str, back.select("row_id", *BIRD_SURVEY.columns).collect())) == sorted(map(str, typed.collect()))
    (tmp_path / "na.csv").write_text('row_id,sex,island\n1,NA,"a, ""b"""\n2,,null\n3,.,n/a\n')
    rows = read_csv(spark, str(tmp_path / "na.csv")).orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [("1", None, 'a, "b"'), ("2", None, None), ("3", ".", None)]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "nothing.csv"))


SCORING = [
    ("adelie_male", "Torgersen", 39.1, 18.7, 181.0, 3750.0, "MALE", 2007, []),
    ("minimum", "Torgersen", 30.0, 13.0, 170.0, 2700.0, "FEMALE", 2007, []),
    ("edge", "Biscoe", 100.0, 50.0, 300.0, 10000.0, "MALE", 2009, []),
    ("bad_island", "InvalidIsland", 39.1, 18.7, 181.0, 3750.0, "MALE", 2007, ["island:vocabulary"]),
    ("bad_length", "Biscoe", -5.0, 18.7, 181.0, 3750.0, "MALE", 2007, ["bill_length_mm:range", "bill_length_mm:scoring_range"]),
    ("below_sanity", "Biscoe", 5.0, 18.7, 181.0, 3750.0, "MALE", 2007, ["bill_length_mm:scoring_range"]),
    ("bad_sex", "Biscoe", 39.1, 18.7, 181.0, 3750.0, "UNKNOWN", 2007, ["sex:vocabulary"]),
    ("no_mass", "Biscoe", 39.1, 18.7, 181.0, None, "MALE", 2007, ["body_mass_g:required"]),
    ("no_sex", "Biscoe", 39.1, 18.7, 181.0, 3750.0, None, 2007, ["sex:required"]),
    ("bad_year", "Biscoe", 39.1, 18.7, 181.0, 3750.0, "MALE", 2010, ["year:range"]),
]
SCORING_SCHEMA = (
    "name string, island string, bill_length_mm double, bill_depth_mm double, flipper_length_mm double, "
    "body_mass_g double, sex string, year int"
)


def test_scoring_input(spark):
    df = spark.createDataFrame([r[:-1] for r in SCORING], SCORING_SCHEMA)
    found = {
        r["name"]: sorted(f"{v['field']}:{v['rule']}" for v in r["violations"])
        for r in C.check_scoring_input(df, BIRD_SURVEY).collect()
    }
    assert found == {r[0]: sorted(r[-1]) for r in SCORING}


def test_scoring_needs_every_column(spark):
    df = spark.createDataFrame([r[:-1] for r in SCORING[:1]], SCORING_SCHEMA).drop("bill_length_mm")
    row = C.check_scoring_input(df, BIRD_SURVEY).first()
    assert [(v["field"], v["rule"]) for v in row["violations"]] == [("bill_length_mm", "required")]


def test_one_sided_bounds(spark):
    spec = TableSpec(key=("k",), numeric=(NumericField("x", high=5, score_low=1), NumericField("y", "bigint", score_high=3)))
    df = spark.createDataFrame([(1, 9.0, 9), (2, 0.5, 3), (3, 5.0, 0)], "k int, x double, y bigint")
    found = {r["k"]: [f"{v['field']}:{v['rule']}" for v in r["violations"]] for r in C.check_scoring_input(df, spec).collect()}
    assert found == {1: ["x:range", "y:scoring_range"], 2: ["x:scoring_range"], 3: []}


def test_profile(spark, raw):
    rows = C.clean(raw, BIRD_SURVEY).unionByName(C.clean(raw, BIRD_SURVEY).limit(1).withColumn("species", F.lit(None).cast("string")))
    summary = P.row_summary(rows, BIRD_SURVEY).first()
    assert (summary["total_rows"], summary["rows_with_target"], summary["total_features"]) == (6, 5, 7)
    assert {(r["feature"], r["missing"]) for r in P.missing_counts(rows, BIRD_SURVEY).collect()} == {
        (c, 1) for c in ("bill_length_mm", "bill_depth_mm", "flipper_length_mm", "body_mass_g", "sex")
    }
    assert [tuple(r) for r in P.target_distribution(rows, "species").collect()] == [("Adelie", 5)]


def test_catalogue(spark, raw):
    rows = C.spec_catalogue(C.clean(raw, BIRD_SURVEY), BIRD_SURVEY).orderBy("position").collect()
    assert [r["feature"] for r in rows] == BIRD_SURVEY.columns
    assert rows[4].asDict() | {"filled_rows": 0} == {
        "position": 4, "feature": "year", "role": "numeric", "dtype": "int", "low": 2007.0, "high": 2009.0,
        "allowed": None, "filled_rows": 0,
    }


def test_spec_from_dict():
    spec = TableSpec.from_dict(
        {
            "key": ["id"],
            "numeric": ["x", {"name": "y", "low": 0}],
            "categorical": [{"name": "c", "allowed": ["a", "b"]}],
            "target": {"name": "t", "allowed": ["p", "q"], "by_substring": True},
        }
    )
    assert spec.columns == ["x", "y", "c", "t"] and spec.categorical[0].allowed == ("a", "b")
    with pytest.raises(ValueError, match="not in the table"):
        spec.with_features(["z"], [])


def test_tokens_without_blank(spark):
    df = spark.createDataFrame([(" ",), ("-",), ("a",)], "c string")
    assert [r[0] for r in df.select(tokens_to_null(F.col("c"), ("-",))).collect()] == [" ", None, "a"]


def test_csv_gives_back_what_was_written(spark, tmp_path):
    rows = [(1, " lead", 'say "hi", x'), (2, "trail ", "a\\b"), (3, "  ", "#"), (4, None, "4-NOT SPECIFIED ")]
    df = spark.createDataFrame(rows, "k int, a string, b string").coalesce(1)
    write_csv(df, str(tmp_path / "a"))
    back = read_csv(spark, str(tmp_path / "a")).orderBy("k").collect()
    assert [(int(r["k"]), r["a"], r["b"]) for r in back] == rows
    broken = spark.createDataFrame([(1, "two\nlines", "x")], "k int, a string, b string")
    with pytest.raises(PySparkException, match="line break"):
        write_csv(broken, str(tmp_path / "b"))
    write_csv(broken, str(tmp_path / "c"), multi_line=True)
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "c"), multi_line=True).collect()] == [("1", "two\nlines", "x")]


@pytest.mark.parametrize("stored", ["double", "bigint", "string"])
def test_number_beyond_the_type_is_a_violation(spark, stored):
    df = spark.createDataFrame([(1, "1000000000000"), (2, "7"), (3, None)], "k int, a string")
    df = df.withColumn("a", F.col("a").cast(stored))
    spec = TableSpec(key=("k",), numeric=(NumericField("a", "int"),))
    got = {r["k"]: (r["a"], [v["rule"] for v in r["violations"]]) for r in C.clean(df, spec, mode="flag").collect()}
    assert got == {1: (None, ["type"]), 2: (7, []), 3: (None, [])}


def test_dates_in_several_formats(spark):
    texts = ["11/11/07", "2007-11-11", "11/11/2007", "2007/11/3", "no day", " ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, day string")
    for flag in (False, True):
        spec = TableSpec(key=("k",), numeric=(NumericField("year", "int"),), date_year=DateYear("day", "year", flag_unparsable=flag))
        rows = C.clean(df, spec, mode="flag").orderBy("k").collect()
        assert [r["year"] for r in rows] == [2007] * 4 + [None] * 3
        assert [[(v["rule"], v["value"]) for v in r["violations"]] for r in rows] == [[]] * 4 + [[("date", "no day")] if flag else []] + [[]] * 2
