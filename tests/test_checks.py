import datetime as dt

import pytest
from pyspark.sql import types as T

from tidemark.operators.validate import component_summary, rule_summary
from tidemark.plans.rules import compile_rules

AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)


def verdict(spark, values, dtype, expectation, as_of=AS_OF, expand_required=True):
    schema = T.StructType([T.StructField("c", dtype)])
    df = spark.createDataFrame([(v,) for v in values], schema)
    suite = compile_rules(spark, [{"field_name": "c", "expectation": expectation,
                                   "expectation_action": "warn"}], df.schema, as_of=as_of,
                          expand_required=expand_required)
    r = rule_summary(df, suite).collect()[0]
    return r["success"], r["missing_count"], r["unexpected_count"]


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def test_required(spark):
    assert verdict(spark, [None, "", "a"], S, "required") == (False, 1, 2)
    assert verdict(spark, [None, "", "a"], S, "required", expand_required=False) == (False, 0, 1)
    assert verdict(spark, ["a", "b"], S, "required") == (True, 0, 0)


def test_choice_text_and_numeric(spark):
    assert verdict(spark, ["A", "B", "C", None], S, "choice('A','B')") == (False, 1, 1)
    # numeric column compared with numeric values; 'x' cannot match and raises nothing
    assert verdict(spark, [1, 2, 3, None], L, "choice(1, 2, 'x')") == (False, 1, 1)
    assert verdict(spark, [1.0, 2.5], D, "choice(1,2.5)") == (True, 0, 0)


def test_date_format(spark):
    vals = ["2024-01-05", "2024-1-5", "05/01/2024", "2023-02-29", "2024-01-05x", None]
    assert verdict(spark, vals, S, "date_format(%Y-%m-%d)") == (False, 1, 3)
    # as strptime: the month takes two digits, the day may have one
    assert verdict(spark, ["20240105", "2024015", "2024-01-05"], S, "date_format(%Y%m%d)") == (False, 0, 1)


def test_time_format(spark):
    vals = ["12:30:01", "7:5:3", "25:00:00", "12-30-01"]
    assert verdict(spark, vals, S, "time_format(%H:%M:%S)") == (False, 0, 2)


def test_format_fallback_for_unmapped_directive(spark):
    vals = ["Mon 01 Jan 2024", "xx 01 Jan 2024", None]
    assert verdict(spark, vals, S, "date_format(%a %d %b %Y)") == (False, 1, 1)


def test_string_format(spark):
    assert verdict(spark, ["abc", "ABC", None], S, "string_format(^[a-z]+$)") == (False, 1, 1)
    # unanchored search, like rlike
    assert verdict(spark, ["xxabcxx"], S, "string_format(abc)") == (True, 0, 0)


def test_string_validation_is_unescaped_regex(spark):
    assert verdict(spark, ["axb", "ab", None], S, "string_validation(a.b)") == (False, 1, 1)


def test_data_type(spark):
    assert verdict(spark, [1, 2], I, "data_type(int)") == (True, 0, 0)
    assert verdict(spark, [1, 2], L, "data_type(int)") == (False, 0, 0)
    assert verdict(spark, [1.5], D, "data_type(decimal)") == (True, 0, 0)
    schema = T.StructType([T.StructField("c", S)])
    df = spark.createDataFrame([("1",), ("x",), (None,)], schema)
    suite = compile_rules(spark, [{"field_name": "c", "expectation": "data_type(int)",
                                   "expectation_action": None}], schema)
    row = component_summary(df, suite).collect()[0]
    assert (row["success"], row["conforming_count"], row["unexpected_count"]) == (False, 1, 0)


def test_number_range(spark):
    assert verdict(spark, [0.0, 5.0, 5.1, None], D, "number_range(0, 5)") == (False, 1, 1)
    # text column: unparsable text is unexpected, not an error
    assert verdict(spark, ["1", "abc", "10", None], S, "number_range(0,5)") == (False, 1, 2)


def test_not_future_datetime(spark):
    vals = [dt.datetime(2024, 1, 15, 12, 0, 0), dt.datetime(2024, 1, 15, 12, 0, 1), None]
    assert verdict(spark, vals, T.TimestampType(), "not_future_datetime") == (False, 1, 1)
    assert verdict(spark, vals, T.TimestampNTZType(), "not_future_datetime") == (False, 1, 1)
    # text compares lexically with the bound text
    assert verdict(spark, ["2024-01-15 11:00:00", "2024-01-16", "01/01/2030"], S,
                   "not_future_datetime") == (False, 0, 1)


def test_not_future_date(spark):
    vals = [dt.datetime(2024, 1, 15, 0, 0, 0), dt.datetime(2024, 1, 15, 0, 0, 1)]
    assert verdict(spark, vals, T.TimestampNTZType(), "not_future_date") == (False, 0, 1)
    dates = [dt.date(2024, 1, 15), dt.date(2024, 1, 16)]
    assert verdict(spark, dates, T.DateType(), "not_future_date") == (False, 0, 1)


def test_lengths(spark):
    assert verdict(spark, ["abc", "abcd", None], S, "max_length(3)") == (False, 1, 1)
    assert verdict(spark, ["abc", "ab", ""], S, "min_length(3)") == (False, 0, 2)
    # numbers are measured as text
    assert verdict(spark, [100, 5], I, "max_length(2)") == (False, 0, 1)


def test_empty_frame(spark):
    assert verdict(spark, [], S, "required and max_length(3)") == (True, 0, 0)


@pytest.mark.parametrize("expectation", ["number_range(1)", "max_length(a)", "data_type(float)"])
def test_bad_arguments_raise(spark, expectation):
    from tidemark.functions.checks import RuleError
    with pytest.raises(RuleError):
        verdict(spark, ["a"], S, expectation)


def test_field_names_are_taken_literally(spark):
    df = spark.createDataFrame([("x", 1), (None, 2)], "`a.b` string, `id x` int")
    suite = compile_rules(spark, [{"field_name": "a.b", "expectation": "required",
                                   "expectation_action": "warn"}], df.schema)
    from tidemark.operators.validate import failing_rows
    rows = failing_rows(df, suite, index_col="id x").collect()
    assert [(r["column_name"], r["id x"]) for r in rows] == [("a.b", 2)]


def test_wide_suites_count_like_narrow_ones(spark, monkeypatch):
    import tidemark.operators.validate as V

    df = spark.createDataFrame([(i, f"v{i}" if i % 7 else None, i / 3) for i in range(30)], "id int, c string, d double")
    texts = [f"max_length({k})" for k in range(1, 8)] + ["required", "data_type(int) and min_length(3)", "data_type(string)",
             "choice('v1','v2') or max_length(2)", "required and max_length(2) or choice('v9') and min_length(1)", "max_length(2)"]
    rules = [{"field_name": f, "expectation": t, "expectation_action": a} for t in texts for f, a in (("c", "warn"), ("c", None), ("d", "drop"))]
    suite = compile_rules(spark, rules, df.schema)
    forms = [lambda d: V.component_summary(d, suite), lambda d: V.rule_summary(d, suite), lambda d: V.failing_rows(d, suite, index_col="id"),
             lambda d: V.row_report(d, suite, "id"), lambda d: V.quality_report(d, suite).drop("proccesed_datetime")]
    seen = lambda: [sorted(map(str, form(d).collect())) for form in forms for d in (df, df.limit(0))]
    want = seen()
    monkeypatch.setattr(V, "MAX_AGGREGATED", 2)
    assert seen() == want


def test_a_thousand_components_are_one_scan(spark):
    import tidemark.operators.validate as V

    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select("p_partkey", "p_name")
    rules = [{"field_name": "p_name", "expectation": f"max_length({k}) or min_length({k + 3})", "expectation_action": "warn"} for k in range(500)]
    suite = compile_rules(spark, rules, df.schema)
    assert len(suite.components) == 1000
    for form in (V.component_summary, V.rule_summary):
        out = form(df, suite)
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    lengths = [len(r["p_name"]) for r in df.collect()]
    got = {r["expectation"]: (r["success"], r["unexpected_count"]) for r in out.collect()}
    for k in range(500):
        over, under = sum(n > k for n in lengths), sum(n < k + 3 for n in lengths)
        either = sum(n > k or n < k + 3 for n in lengths)
        assert got[f"max_length({k}) or min_length({k + 3})"] == (not over or not under, 0 if not over or not under else either)
    listed = V.failing_rows(df.withColumnRenamed("p_partkey", "RowIndex"), suite, verdicts=out)
    assert listed._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2  # the rows, and the verdicts


def test_schema_verdict_inside_or_rule(spark):
    from tidemark.operators.validate import failing_rows

    df = spark.createDataFrame([(1, "long text"), (2, "x")], "id int, c string")
    for expectation, passed in (("data_type(string) or max_length(1)", True),
                                ("data_type(int) or max_length(1)", False),
                                ("data_type(string) and max_length(1)", False)):
        suite = compile_rules(spark, [{"field_name": "c", "expectation": expectation,
                                       "expectation_action": "warn"}], df.schema)
        r = rule_summary(df, suite).collect()[0]
        ids = sorted(x["id"] for x in failing_rows(df, suite, index_col="id").collect())
        assert (r["success"], r["unexpected_count"], ids) == (
            (True, 0, []) if passed else (False, 1, [1])), expectation


def test_reports_on_an_empty_frame(spark):
    from tidemark.operators.validate import failing_rows, quality_report, row_report

    df = spark.createDataFrame([], "id int, c string")
    rules = [{"field_name": "c", "expectation": "required or max_length(2)", "expectation_action": "warn"},
             {"field_name": "c", "expectation": "data_type(int)", "expectation_action": "warn"}]
    suite = compile_rules(spark, rules, df.schema)
    assert sorted((r["expectation"], r["success"], r["unexpected_count"])
                  for r in quality_report(df, suite).collect()) == [
        ("data_type(int)", False, 0), ("required or max_length(2)", True, 0)]
    assert failing_rows(df, suite, index_col="id").count() == 0
    rr = row_report(df, suite, "id").collect()
    assert sorted((r["expectation_type"], r["status"]) for r in rr) == [
        ("data_type", False), ("max_length", True), ("min_length", True), ("required", True)]
    assert all(r["id"] is None and r["unexpected_value"] is None for r in rr)


def test_large_value_sets_are_a_table(spark):
    from tidemark.operators.validate import component_summary, failing_rows, row_report

    df = spark.createDataFrame([(1, "v3", 3), (2, "x", 70001), (3, None, None), (4, "v99999", 99999), (5, "v3", 3)], "id int, c string, n int")
    values = ",".join(f"'v{k}'" for k in range(100_000))
    rules = [{"field_name": "c", "expectation": f"required and choice({values})", "expectation_action": "warn"},
             {"field_name": "n", "expectation": "choice(" + ",".join(str(k) for k in range(70_000)) + ",3,99999,zz)", "expectation_action": "warn"}]
    suite = compile_rules(spark, rules, df.schema)
    out = failing_rows(df, suite, index_col="id")
    assert sorted((r["column_name"], r["id"]) for r in out.collect()) == [("c", 2), ("c", 3), ("n", 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000 and "INSET" not in plan and plan.count("Join LeftOuter") == 2
    counts = {(r["column_name"], r["rule_name"]): (r["missing_count"], r["unexpected_count"]) for r in component_summary(df, suite).collect()}
    assert counts == {("c", "required"): (0, 1), ("c", "choice"): (1, 1), ("n", "choice"): (1, 1)} | ({("c", "min_length"): (1, 0)} if ("c", "min_length") in counts else {})
    assert row_report(df, suite, "id").where("status = false").count() == 3


def test_a_value_set_of_one_more_than_the_literals(spark, monkeypatch):
    import tidemark.functions.checks as C
    from tidemark.operators.validate import failing_rows

    df = spark.createDataFrame([(k, float(k) / 2, f"{k}") for k in range(20)] + [(99, None, None)], "id int, d double, s string")
    rules = [{"field_name": f, "expectation": f"choice({v})", "expectation_action": "warn"} for f, v in (("d", "1,1.0,2.5,3"), ("s", "'1','2','1','7'"))]
    seen = []
    for literal in (1000, 2):
        monkeypatch.setattr(C, "LITERAL_VALUES", literal)
        seen.append(sorted(map(str, failing_rows(df, compile_rules(spark, rules, df.schema), index_col="id").collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 34
