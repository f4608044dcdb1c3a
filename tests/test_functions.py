import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from rollcall.functions.dates import hire_date, in_year, quarter_label
from rollcall.operators.normalise import normalise_history
from rollcall.schemas import TABLES, read_schema, schema_from_text, table_schema
from rollcall.session import settings_for

GOOD = {
    "2021-11-07T02:48:42Z": dt.date(2021, 11, 7),
    "2020-02-29": dt.date(2020, 2, 29),
    "2021-1-5": dt.date(2021, 1, 5),
    "0": None,
    None: None,
}
BAD = ["", "2021", "2021-5", "2021-02-30", "yesterday", "2021-13-01", "2021-1-5T0", "12021-01-01"]


def dates(spark, texts, mode):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return [r[0] for r in df.select(hire_date(F.col("t"), mode)).collect()]


@pytest.mark.parametrize("mode", ["raise", "null"])
def test_good_dates(spark, mode):
    assert dates(spark, GOOD, mode) == list(GOOD.values())


@pytest.mark.parametrize("text", BAD)
def test_bad_dates(spark, text):
    assert dates(spark, [text], "null") == [None]
    with pytest.raises(PySparkException):
        dates(spark, [text], "raise")


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        hire_date(F.lit("x"), "ignore")


def test_quarters_and_years_at_their_edges(spark):
    days = ["2020-12-31", "2021-01-01", "2021-03-31", "2021-04-01", "2021-12-31", "2022-01-01"]
    df = spark.createDataFrame([(d,) for d in [*days, None]], "t STRING").withColumn(
        "d", F.col("t").cast("date")
    )
    assert [r[0] for r in df.select(quarter_label(F.col("d"))).collect()] == [
        "Q4", "Q1", "Q1", "Q2", "Q4", "Q1", None,
    ]
    assert [r[0] for r in df.filter(in_year(F.col("d"), 2021)).select("t").collect()] == days[1:5]


def test_normalise_history(spark):
    df = spark.createDataFrame(
        [(None, 1.9, None, "2021-01-01"), (3, None, "bob", None), (4, -1.9, "amy", "0"),
         (5, float("nan"), "", "x")],
        "id BIGINT, f DOUBLE, name STRING, datetime STRING",
    )
    out = normalise_history(df)
    assert rows(out) == [
        (0, 1, "0", "2021-01-01"), (3, 0, "bob", "0"), (4, -1, "amy", "0"), (5, 0, "", "x"),
    ]
    assert dict(out.dtypes)["f"] == "bigint"


def test_normalise_keeps_large_decimals_exact(spark):
    df = spark.sql("SELECT CAST(9007199254740993.75 AS DECIMAL(38, 18)) AS id")
    assert rows(normalise_history(df)) == [(9007199254740993,)]


def test_schema_text(spark, tmp_path):
    assert schema_from_text("id INT64,\nname string,\n n integer") == schema_from_text(
        "id BIGINT, name STRING, n BIGINT"
    )
    path = tmp_path / "jobs.txt"
    path.write_text("id INT64,\njob STRING\n")
    assert read_schema(spark, str(path)) == table_schema("jobs")
    assert set(TABLES) == {"hired_employees", "departments", "jobs"}


def test_settings_follow_the_size(spark):
    partitions = [
        int(settings_for(size)["spark.sql.shuffle.partitions"]) for size in (0, 2**40, 100 * 2**40)
    ]
    assert partitions == [200, 4096, 100_000]


def test_strict_dates_do_not_depend_on_the_session(spark, conf):
    conf(spark__sql__ansi__enabled="false")
    frame = spark.createDataFrame([("2021-02-03T00:00:00Z",), ("0",), (None,)], "t STRING")
    assert [r[0] for r in frame.select(hire_date(F.col("t")).cast("string")).collect()] == ["2021-02-03", None, None]
    for bad in ("2021-13-45", "", "x", "2021-02-30T01"):
        with pytest.raises(Exception, match="not a calendar date"):
            spark.createDataFrame([(bad,)], "t STRING").select(hire_date(F.col("t"))).collect()
