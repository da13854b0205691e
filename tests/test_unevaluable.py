"""Rules that are no rules raise; rules that can't be evaluated are listed and
the others are checked."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import RuleError, check_data_quality, compile_rules
from tidemark.plans.rules import session_clock, skipped_frame


def _rule(field, expectation):
    return {"field_name": field, "expectation": expectation, "expectation_action": "warn"}


@pytest.mark.parametrize("text", ["required AND not_future_date", "required foo", "not_future_date blah",
                                  "required OR max_length(3)", "max_length(3) and required foo", "choice('a') x"])
def test_text_left_over_raises(spark, text):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(RuleError):
        compile_rules(spark, [_rule("c", text)], df.schema)


@pytest.fixture(scope="module")
def typed(spark):
    return spark.sql("""SELECT 1 AS id, 'x' AS s, DATE'2024-01-05' AS d, TIMESTAMP_NTZ'2024-01-05 10:00:00' AS n,
                        TIMESTAMP'2024-01-05 10:00:00' AS t, X'00' AS b, array(1, 2) AS a""")


@pytest.mark.parametrize("column", ["d", "n", "b", "a"])
@pytest.mark.parametrize("kind", ["int", "decimal", "bit"])
def test_data_type_of_a_column_without_such_a_form(spark, typed, column, kind):
    _, rep = check_data_quality(1, "s", "t", "b", rules=[_rule(column, f"data_type({kind})"), _rule("s", "required")],
                                df=typed, index_col="id")
    got = {r["column_name"]: (r["success"], r["unexpected_count"]) for r in rep.collect()}
    assert got == {column: (False, 0), "s": (True, 0)}


@pytest.mark.parametrize("column", ["d", "n", "b", "a"])
def test_number_range_without_a_number_is_listed(spark, typed, column):
    _, rep, skipped = check_data_quality(1, "s", "t", "b", rules=[_rule(column, "number_range(0, 1)"), _rule("s", "required")],
                                         df=typed, index_col="id", return_skipped=True)
    assert [r["column_name"] for r in rep.collect()] == ["s"]
    assert [(r["column_name"], r["expectation"]) for r in skipped.collect()] == [(column, "number_range(0, 1)")]


def test_bad_patterns_and_missing_columns_are_listed_with_reasons(spark):
    df = spark.createDataFrame([("2024-01-05", 1), ("x", 2)], "Name string, id int")
    rules = [_rule("name", "required"), _rule("NAME", "string_format([)"), _rule("name", "string_validation(*)"),
             _rule("name", "date_format(%Q)"), _rule("nme", "required"), _rule("name", "requird"),
             _rule("name", "date_format(%Y-%m-%d) and string_format([)")]
    _, rep, skipped = check_data_quality(1, "s", "t", "b", rules=rules, df=df, index_col="id", return_skipped=True)
    got = {r["expectation"]: r["unexpected_count"] for r in rep.collect()}
    assert got == {"required": 0, "date_format(%Y-%m-%d) and string_format([)": 1}
    reasons = {(r["column_name"], r["expectation"]): r["reason"] for r in skipped.collect()}
    assert set(reasons) == {("NAME", "string_format([)"), ("name", "string_validation(*)"), ("name", "date_format(%Q)"),
                            ("nme", "required"), ("name", "requird"), ("name", "date_format(%Y-%m-%d) and string_format([)")}
    assert reasons["nme", "required"] == "column not found"
    assert reasons["name", "requird"] == "unknown rule name"


def test_column_names_match_as_the_session_matches_them(spark):
    df = spark.createDataFrame([("a",)], "Name string")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(RuleError):
            compile_rules(spark, [_rule("NAME", "required")], df.schema)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert len(compile_rules(spark, [_rule("NAME", "required")], df.schema).rules) == 1


def test_catalogue_collects_distinct_rules_only(spark):
    rules = spark.range(500).select(F.lit("c").alias("field_name"), F.concat(F.lit("max_length("), F.col("id") % 3, F.lit(")")).alias("expectation"),
                                    F.lit("warn").alias("expectation_action"))
    suite = compile_rules(spark, rules, spark.createDataFrame([("a",)], "c string").schema)
    assert len(suite.rules) == 3 and skipped_frame(spark, suite).count() == 0


@pytest.mark.parametrize("value,kind,choice,ok", [
    (9007199254740992, "bigint", "9007199254740993", False), (9007199254740993, "bigint", "9007199254740993", True),
    (0.1, "float", "0.1", True), (0.1, "double", "0.1", True), (5, "int", "5.0", True), (5, "int", "5.5", False),
    (5, "tinyint", "700", False), (1, "int", "x", False)])
def test_choice_compares_in_the_columns_type(spark, value, kind, choice, ok):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    _, rep = check_data_quality(1, "s", "t", "b", rules=[_rule("c", f"choice({choice})")], df=df, number_rows=False)
    assert rep.first()["success"] is ok


def test_choice_of_decimals_is_exact(spark):
    df = spark.sql("SELECT CAST(1.10 AS DECIMAL(9, 2)) AS c")
    got = [check_data_quality(1, "s", "t", "b", rules=[_rule("c", f"choice({v})")], df=df, number_rows=False)[1].first()["success"]
           for v in ("1.1", "1.10", "1.101")]
    assert got == [True, True, False]


def test_the_clock_is_the_sessions(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        now = session_clock(spark)
        utc = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        assert dt.timedelta(hours=6, minutes=59) < utc - now < dt.timedelta(hours=8, minutes=1)
        df = spark.sql("SELECT current_timestamp() + INTERVAL 4 HOURS AS t")
        _, rep = check_data_quality(1, "s", "t", "b", rules=[_rule("t", "not_future_datetime")], df=df, number_rows=False)
        assert rep.first()["unexpected_count"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_string_validation_searches(spark):
    df = spark.createDataFrame([("x" * 50000,), ("ax+b",)], "c string")
    for pattern, failing in (("ax", 1), ("x[+]b", 1), ("a.+b|y", 1), ("z", 2)):
        _, rep = check_data_quality(1, "s", "t", "b", rules=[_rule("c", f"string_validation({pattern})")], df=df, number_rows=False)
        assert rep.first()["unexpected_count"] == failing


def test_the_report_copies_nothing(spark, tmp_path):
    """No checkpoint is written, and only the ruled column is read."""
    spark.range(50).selectExpr("id", "string(id) AS name", "repeat('x', 100) AS other").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).repartition(3, "id")
    folder = tmp_path / "checkpoints"
    spark.sparkContext.setCheckpointDir(str(folder))
    _, rep = check_data_quality(1, "s", "t", "b", rules=[_rule("name", "required")], df=df, number_rows=False)
    assert rep.collect()
    assert not [f for f in folder.rglob("*") if f.is_file()]
    assert all("other" not in line for line in rep._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line)
