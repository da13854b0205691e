"""Golden tests from FIXTURES.md (members, look-ahead readings, profile records)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.split_window import LaterNonNull, Lead, SplitWindow
from tidemark.operators.profiles import set_state_profile
from tidemark.operators.validate import (
    check_data_quality, failing_rows, quality_report, row_report, with_index_rows,
)
from tidemark.plans.rules import compile_rules

EMAIL = r"^\S+@\w+(\.\w+){1,3}$"
RULES = [
    {"field_name": "name", "expectation": "required", "expectation_action": "warn"},
    {"field_name": "email", "expectation": f"required and string_format({EMAIL})",
     "expectation_action": "warn"},
]


def users(spark):
    schema = T.StructType([
        T.StructField("user_id", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()), T.StructField("age", T.IntegerType()),
        T.StructField("signup_date", T.TimestampType()),
    ])
    data = [
        (1, "Ada", "ada@north.example", 61, dt.datetime(2019, 5, 4)),
        (2, "Bela", "bela@mail.south.example", 18, dt.datetime(2022, 11, 30)),
        (3, "Cato", "cato at home", 200, dt.datetime(2021, 7, 7)),
        (4, "Dora", "d@east.example", 33, dt.datetime(2020, 2, 29)),
        (5, "", None, None, None),
        (6, "Emil", None, 47, dt.datetime(2020, 2, 29)),
    ]
    return spark.createDataFrame(data, schema)


def test_users_row_report(spark):
    df = users(spark)
    suite = compile_rules(spark, RULES, df.schema, expand_required=False)
    key = lambda t: tuple(str(x) for x in t)
    got = sorted((tuple(r) for r in row_report(df, suite, "user_id").collect()), key=key)
    assert got == sorted([
        ("required", "name", True, 0, None, None),
        ("required", "email", False, 2, None, 5),
        ("required", "email", False, 2, None, 6),
        ("string_format", "email", False, 1, "cato at home", 3),
    ], key=key)


def test_users_quality_report_end_to_end(spark):
    df, rep = check_data_quality(1, "crm", "users", "b1", rules=RULES, df=users(spark),
                                 processed_at=dt.datetime(2024, 1, 1))
    assert "RowIndex" in df.columns
    got = {r["column_name"]: (r["success"], r["missing_count"], r["unexpected_count"])
           for r in rep.collect()}
    assert got == {"name": (False, 0, 1), "email": (False, 4, 3)}
    suite = compile_rules(spark, RULES, df.schema)
    rows = failing_rows(df, suite).collect()
    assert sorted((r["column_name"], r["RowIndex"]) for r in rows) == [
        ("email", 3), ("email", 5), ("email", 6), ("name", 5)]
    listed = with_index_rows(quality_report(df, suite), failing_rows(df, suite)).collect()
    assert sorted((r["column_name"], r["unexpected_count"], r["RowIndex"]) for r in listed) == [
        ("email", 3, 3), ("email", 3, 5), ("email", 3, 6), ("name", 1, 5)]


def test_end_to_end_with_index_rows(spark):
    _, rep = check_data_quality(1, "crm", "users", "b1", rules=RULES, df=users(spark),
                                processed_at=dt.datetime(2024, 1, 1), index_rows=True)
    assert sorted(((r["column_name"], r["RowIndex"], r["value"]) for r in rep.collect()), key=str) == [
        ("email", 3, "cato at home"), ("email", 5, None), ("email", 6, None), ("name", 5, "")]


def test_row_report_sample_limit(spark):
    df = users(spark)
    suite = compile_rules(spark, RULES, df.schema, expand_required=False)
    rows = row_report(df, suite, "user_id", sample_limit=1).collect()
    req = [r for r in rows if r["expectation_type"] == "required" and r["column"] == "email"]
    assert [r["user_id"] for r in req] == [5] and req[0]["unexpected_count"] == 2


def test_or_rule_is_combined_at_dataset_level(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abcdef"), (3, "A")], "id int, c string")
    suite = compile_rules(spark, [{"field_name": "c", "expectation": "min_length(2) or max_length(3)",
                                   "expectation_action": "warn"}], df.schema)
    rep = quality_report(df, suite).collect()[0]
    assert (rep["success"], rep["unexpected_count"]) == (False, 2)
    assert sorted(r["id"] for r in failing_rows(df, suite, index_col="id").collect()) == [2, 3]


def _lookahead(spark, rows, policy=None):
    df = spark.createDataFrame(rows, "meter string, day string, ok int")
    sw = SplitWindow(df, ["meter"], ["day"], policy)
    valid = F.col("ok") == 1
    x = sw.add(sw.prepare(df), later=LaterNonNull(F.when(valid, F.lit(True))), one=Lead(F.when(valid, F.lit(True))),
               two=Lead(F.when(valid, F.lit(True)), 2))
    out = sw.finish(x).withColumn("soon", F.col("one") | F.col("two")).orderBy("meter", "day").collect()
    return [(r["later"], r["soon"]) for r in out]


def test_lookahead_readings(spark):
    rows = [("m1", "07-01", 0), ("m1", "07-02", 1), ("m1", "07-03", 0), ("m1", "07-04", 0), ("m1", "07-05", 0), ("m1", "07-06", 1),
            ("m2", "07-01", 0), ("m2", "07-02", 0)]
    assert _lookahead(spark, rows) == [
        (True, True), (True, None), (True, None), (True, True), (True, True), (None, None), (None, None), (None, None)]


def _d(s):
    return dt.date.fromisoformat(s) if s else None


PROFILE_ROWS = [
    # key, effective, type, id, escheat, sold, replacement
    ("K1", "2020-01-01", "S", 101, "2021-06-01", "2020-06-01", None),
    ("K1", "2020-03-01", "O", 102, "2021-06-01", "2020-06-01", None),
    ("K1", "2020-04-01", "S", 103, "2021-06-01", "2020-06-01", None),
    ("K1", "2020-09-01", "S", 104, "2021-06-01", "2020-06-01", None),
    ("K1", "2021-01-01", "O", 105, "2021-06-01", "2020-06-01", None),
    ("K2", "2019-01-01", "O", 201, "2020-01-01", None, None),
    ("K2", "2019-06-01", "O", 202, "2019-07-01", None, None),
    ("K2", "2019-06-15", "O", 203, "2022-01-01", None, None),
    ("K2", "2019-12-01", "O", 204, "2020-02-01", None, None),
    ("K2", "2020-02-01", "O", 205, None, None, None),
    ("K3", "2020-01-01", "O", 301, None, None, None),
    ("K3", "2020-02-01", "O", 302, None, None, None),
    ("K4", "2020-01-01", "O", 401, "2020-01-15", None, None),
    ("K4", "2020-03-01", "O", 402, "2020-06-01", None, None),
    ("K4", "2020-04-01", "O", 403, "2020-04-15", None, None),
    ("K5", "2020-01-01", "S", 501, "2021-01-01", "2019-01-01", "2020-05-01"),
    ("K5", "2020-02-01", "S", 502, "2021-01-01", "2019-01-01", None),
    ("K5", "2020-03-01", "O", 503, "2021-01-01", "2019-01-01", "2020-05-01"),
    ("K6", "2020-01-01", "O", 601, "2020-01-15", None, None),
    ("K6", "2020-03-01", "O", 602, "2020-06-01", None, None),
    ("K6", "2020-04-01", "O", 603, "2020-04-15", None, None),
    ("K6", "2020-04-10", "O", 604, "2020-05-01", None, None),
    ("K7", "2020-01-01", "O", 701, "2020-06-01", None, None),
    ("K7", "2020-02-01", "O", 702, None, None, None),
    ("K7", "2020-07-01", "O", 703, "2020-12-01", None, None),
    ("K8", "2020-01-01", "O", 801, "2020-01-10", "2020-12-01", None),
    ("K8", "2020-02-01", "O", 802, "2020-03-01", "2020-12-01", None),
    ("K8", "2020-02-15", "O", 803, "2020-03-01", "2020-12-01", None),
    ("K8", "2020-03-15", "S", 804, "2021-01-01", "2020-12-01", None),
    ("K9", "2020-03-15", "S", 901, "2021-01-01", "2019-12-01", None),
]


def profiles(spark):
    rows, pos = [], {}
    for key, eff, typ, pid, esc, sold, repl in PROFILE_ROWS:
        pos[key] = pos.get(key, 0) + 1
        rows.append((key, _d(eff), pos[key], "SOLDONORAFTER" if typ == "S" else "OTHER", pid,
                     _d(esc), _d(sold), _d(repl)))
    schema = ("Key string, SP_EffectiveDate date, SP_ProfileId int, SP_EffectiveDateType string, "
              "SP_ID int, EscheatDate date, SoldDate date, ReplacementDate date")
    return spark.createDataFrame(rows, schema)


def _winners(spark, lookback, pick="max_by"):
    out = set_state_profile(
        prefix="P", df=profiles(spark), unique_fields=["Key"], state_profile="StateProfile",
        escheat_date_field_name="EscheatDate", escheat_due_date_field_name="EscheatDueDate",
        state_profiles_prefix="SP_", lookback=lookback, pick=pick,
    )
    rows = out.collect()
    assert all(r["P_ValidProfile"] == 1 for r in rows)
    assert "SP_ProfileId" not in out.columns and "StateProfile" in out.columns
    return {r["Key"]: r["StateProfile"] for r in rows}


def test_profile_running(spark):
    want = {"K1": 105, "K2": 205, "K3": 301, "K4": 401, "K5": 503, "K6": 601, "K7": 702, "K8": 804}
    assert _winners(spark, "running") == want
    assert _winners(spark, "running", pick="window") == want


def test_profile_adjacent(spark):
    want = {"K1": 105, "K2": 205, "K3": 301, "K4": 401, "K5": 503, "K6": 604, "K7": 703, "K8": 801}
    assert _winners(spark, "adjacent") == want
    assert _winners(spark, "adjacent", pick="window") == want


def test_catalog_rules_and_batch_end_to_end(spark):
    rules = spark.createDataFrame([
        (1, "Users", "name", "required", "warn", 1),
        (1, "USERS", "email", f"required and string_format({EMAIL})", "warn", 1),
        (1, "users", "age", "number_range(0, 120)", "drop", 0),      # inactive
        (2, "users", "age", "number_range(0, 120)", "drop", 1),      # other system
        (1, "users", "age", None, "drop", 1),                        # no expectation
    ], "source_system_id int, table_name string, field_name string, expectation string, "
       "expectation_action string, active int")
    rules.createOrReplaceTempView("tm_dq_rules")
    batches = users(spark).withColumn(
        "batch_id", F.when(F.col("user_id") <= 6, F.lit("b1")).otherwise(F.lit("b0")))
    batches.unionByName(batches.withColumn("batch_id", F.lit("b2"))) \
        .createOrReplaceTempView("crm_users")
    df, rep = check_data_quality(1, "CRM", "Users", "b1", rules_table="tm_dq_rules",
                                 processed_at=dt.datetime(2024, 1, 1))
    assert sorted(r["RowIndex"] for r in df.collect()) == [1, 2, 3, 4, 5, 6]
    got = {r["column_name"]: (r["success"], r["missing_count"], r["unexpected_count"],
                              r["table_name"], r["batch_id"]) for r in rep.collect()}
    assert got == {"name": (False, 0, 1, "Users", "b1"), "email": (False, 4, 3, "Users", "b1")}


def test_index_rows_for_rule_with_null_action(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id int, c string")
    rules = [{"field_name": "c", "expectation": "required", "expectation_action": None},
             {"field_name": "c", "expectation": "max_length(9)", "expectation_action": None}]
    _, rep = check_data_quality(1, "s", "t", "b", rules=rules, df=df, index_col="id", index_rows=True)
    assert sorted((r["expectation"], r["action"], r["id"]) for r in rep.collect()) == [
        ("max_length(9)", None, None), ("required", None, 2)]


def test_date_helpers_in_either_form(spark):
    base = profiles(spark).drop("EscheatDate")
    esc = {pid: e for _, _, _, pid, e, _, _ in PROFILE_ROWS}  # SP_ID -> escheat date

    def long_form(prefix, df, field):
        m = spark.createDataFrame([(i, _d(e)) for i, e in esc.items()], f"SP_ID int, `{field}` date")
        return df.join(m, "SP_ID")

    def due_long(prefix, df, field, due):
        return df.withColumn(due, F.date_add(F.col(field), 30))

    out = set_state_profile(
        prefix="P", df=base, unique_fields=["Key"], state_profile="StateProfile",
        escheat_date_field_name="EscheatDate", escheat_due_date_field_name="EscheatDueDate",
        state_profiles_prefix="SP_", set_escheat_date=long_form, get_escheat_due_date=due_long,
    )
    assert "EscheatDueDate" in out.columns
    assert {r["Key"]: r["StateProfile"] for r in out.collect()}["K6"] == 601


def test_entry_point_edges(spark):
    import pytest

    df = users(spark).withColumn("RowIndex", F.col("user_id").cast("long") * 10)
    with pytest.raises(ValueError):
        check_data_quality(1, "crm", "users", "b1", rules=[], df=df)
    out, rep = check_data_quality(1, "crm", "users", "b1", rules=RULES, df=df, index_rows=True)
    assert sorted(r["RowIndex"] for r in out.collect()) == [10, 20, 30, 40, 50, 60]
    assert sorted((r["column_name"], r["RowIndex"]) for r in rep.collect()) == [
        ("email", 30), ("email", 50), ("email", 60), ("name", 50)]
    with pytest.raises(ValueError):
        set_state_profile(prefix="P", df=profiles(spark), unique_fields=["Key"],
                          state_profile="S", escheat_date_field_name="EscheatDate",
                          escheat_due_date_field_name="D", state_profiles_prefix="SP_",
                          lookback="sideways")
    with pytest.raises(ValueError):
        set_state_profile(prefix="P", df=profiles(spark).drop("EscheatDate"), unique_fields=["Key"],
                          state_profile="S", escheat_date_field_name="EscheatDate",
                          escheat_due_date_field_name="D", state_profiles_prefix="SP_")


def test_pick_keeps_input_column_order(spark):
    kw = dict(prefix="P", unique_fields=["Key"], state_profile="StateProfile",
              escheat_date_field_name="EscheatDate", escheat_due_date_field_name="D",
              state_profiles_prefix="SP_")
    a = set_state_profile(df=profiles(spark), **kw).columns
    b = set_state_profile(df=profiles(spark), pick="window", **kw).columns
    assert a == b
    assert a[-2:] == ["P_ValidProfile", "StateProfile"] and "SP_ProfileId" not in a
