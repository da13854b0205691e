"""Registered queries over the driver's tables.

Every query reads whole tables; the only limit is a feature itself, the partial
sample that the caller asks for (``dq_row_report_sample``: first 5 failing rows
per check; ``dq_row_report`` is the complete form). The driver tables hold no NULLs, so NULLs are injected by
a fixed expression, mirrored in the SQL oracle. Outputs are scalar columns
(ids, counts, flags, text values); dates leave as day numbers so both engines
hash them alike. The ``*_hot`` queries repeat window and profile queries with
tiny hot-key thresholds, so the split plan is checked against the same SQL.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profiles import profile_stages, set_state_profile
from ..operators.split_window import (
    DEFAULT_POLICY, FirstNonNull, Lag, LastNonNullBefore, LastNonNullUpTo, Lead, LaterNonNull,
    Op, RowNumber, SplitPolicy, SplitWindow,
)
from ..operators.row_index import with_row_index
from ..operators.validate import (
    check_data_quality, component_summary, failing_rows, quality_report, row_report,
    rule_summary, with_index_rows,
)
from ..sources.tables import batch_of, infer_types, parse_csv_lines, read_batch, read_table, typed
from .rules import compile_rules, expand_rules, lookup_rules

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = _dt.datetime(2024, 1, 15, 12, 0, 0)
PROCESSED_AT = _dt.datetime(2024, 1, 16, 0, 0, 0)


def _rule(field: str, expectation: str, action: str | None = "warn") -> dict:
    return {"field_name": field, "expectation": expectation, "expectation_action": action}


# ---------------------------------------------------------------- inputs


def orders_q(spark: SparkSession, sf: str) -> DataFrame:
    """orders with NULLs injected: status P -> NULL, every 13th priority -> NULL."""
    o = read_table(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def rule_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """A rules table derived from ``part`` (one rule per part)."""
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    ptype = F.col("p_type")
    table = (
        F.when(k % 3 == 0, F.lower(ptype))
        .when(k % 3 == 1, ptype)
        .otherwise(F.concat(F.upper(F.substring(ptype, 1, 1)), F.lower(F.substring(ptype, 2, 100))))
    )
    field = (
        F.when(k % 4 == 0, F.lit("p_name")).when(k % 4 == 1, F.lit("p_brand"))
        .when(k % 4 == 2, F.lit("p_type")).otherwise(F.lit("p_comment"))
    )
    expectation = (
        F.when(k % 8 == 0, F.lit("required"))
        .when(k % 8 == 1, F.lit("choice('A','B') or min_length(3)"))
        .when(k % 8 == 2, F.lit("choice('salt and pepper')"))
        .when(k % 8 == 3, F.lit("Required and max_length(20)"))
        .when(k % 16 == 4, F.lit("string_format(^a and (b)$) or max_length(30)"))
        .when(k % 8 == 5, F.lit("unknown_rule(3)"))
        .when(k % 8 == 6, F.lit("string_format(^[a-z]+ [a-z]+$) and max_length(12)"))
        .when(k % 8 == 7, F.lit("not_future_date or string_validation(ring)"))
    )
    action = F.when(F.col("p_size") % 3 == 0, F.lit("warn")).when(F.col("p_size") % 3 == 1, F.lit("drop"))
    return p.select(
        k.alias("rule_key"),
        (F.col("p_size") % 5).cast("int").alias("source_system_id"),
        table.alias("table_name"),
        field.alias("field_name"),
        expectation.alias("expectation"),
        action.alias("expectation_action"),
        F.when(k % 7 != 0, F.lit(1)).otherwise(F.lit(0)).alias("active"),
    )


def _events_value(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select(
        "event_id", "user_id", "ts", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
    )


def profile_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (customer, order): the order is a candidate profile."""
    o = read_table(spark, sf, "orders")
    ck = F.col("o_custkey")
    return o.select(
        ck.alias("AccountId"),
        F.to_date("o_orderdate").alias("SP_EffectiveDate"),
        F.col("o_orderkey").alias("SP_ProfileId"),
        F.col("o_orderkey").alias("SP_ID"),
        F.when(F.col("o_orderstatus") == "F", F.lit("SOLDONORAFTER")).otherwise(F.lit("OTHER"))
        .alias("SP_EffectiveDateType"),
        F.date_add(F.lit(_dt.date(1995, 6, 1)), (ck % 2000).cast("int")).alias("SoldDate"),
        F.when(ck % 3 == 0, F.date_add(F.lit(_dt.date(1997, 1, 1)), (ck % 1000).cast("int")))
        .alias("ReplacementDate"),
    )


def set_escheat_date(df: DataFrame) -> DataFrame:
    pid = F.col("SP_ID")
    return df.withColumn(
        "EscheatDate",
        F.when(pid % 5 != 0, F.date_add("SP_EffectiveDate", (pid % 400).cast("int"))),
    )


def get_escheat_due_date(df: DataFrame) -> DataFrame:
    return df.withColumn("EscheatDueDate", F.date_add("EscheatDate", 90))


def _days(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.datediff(col, F.lit(_dt.date(1970, 1, 1))).cast("bigint")


# ---------------------------------------------------------------- rules


def q_rules_lookup(spark, sf):
    return lookup_rules(rule_catalogue(spark, sf), 2, "Economy")


def q_rules_expand(spark, sf):
    cat = rule_catalogue(spark, sf)
    return expand_rules(cat).select(
        "rule_key", "component_no", "operator", "component", "rule_name",
        F.array_join("args", "|").alias("args_text"),
    )


def q_batch_rows(spark, sf):
    e = read_table(spark, sf, "events").withColumn(
        "batch_id", (F.col("user_id") % 10).cast("string"))
    return batch_of(e, "3", order_by=["event_id"]).select("event_id", "user_id", "RowIndex")


def q_row_index_shuffled(spark, sf):
    """Numbering a frame that comes out of a shuffle, by default: every row has
    a number, and the numbers are 1..n."""
    keys = read_table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").dropDuplicates()
    return with_row_index(keys).agg(F.count("*").alias("n"), F.countDistinct("RowIndex").alias("numbers"),
                                    F.min("RowIndex").alias("first"), F.max("RowIndex").alias("last"))


def q_batch_of_view(spark, sf):
    """``read_batch`` of a catalogue name that is a view with a shuffle."""
    o = read_table(spark, sf, "orders")
    o.groupBy("o_custkey", F.concat(F.lit("b"), F.col("o_orderkey") % 3).alias("batch_id")).agg(
        F.count("*").alias("orders")).createOrReplaceTempView("tm_orders_batches")
    batch = read_batch(spark, "tm_orders_batches", "b1")
    return batch.agg(F.count("*").alias("n"), F.countDistinct("RowIndex").alias("numbers"), F.min("RowIndex").alias("first"),
                     F.max("RowIndex").alias("last"), F.sum("orders").alias("orders"))


def q_row_index(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return with_row_index(o, "RowIndex", order_by=["o_orderkey"])


# ---------------------------------------------------------------- single rules


def _failing(df: DataFrame, rules: list[dict], index_col: str, spark: SparkSession,
             with_value: bool = True, **kw) -> DataFrame:
    suite = compile_rules(spark, rules, df.schema, as_of=kw.get("as_of", AS_OF))
    out = failing_rows(df, suite, index_col=index_col)
    cols = ["column_name", "expectation", "action", index_col] + (["value"] if with_value else [])
    return out.select(*cols)


def q_dq_required(spark, sf):
    return _failing(orders_q(spark, sf), [_rule("o_orderstatus", "required")], "o_orderkey", spark)


def q_dq_choice(spark, sf):
    rules = [_rule("o_orderpriority", "choice('1-URGENT','2-HIGH')")]
    return _failing(orders_q(spark, sf), rules, "o_orderkey", spark)


def q_dq_choice_large(spark, sf):
    """A set of 100,000 allowed texts, and one of as many numbers."""
    o = read_table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("customer"), "o_custkey")
    rules = [_rule("customer", "choice(" + ",".join(f"'C{k}'" for k in range(0, 200_000, 2)) + ")", "text"),
             _rule("o_custkey", "required and choice(" + ",".join(str(k) for k in range(1, 300_000, 3)) + ")", "number")]
    suite = compile_rules(spark, rules, o.schema, as_of=AS_OF)
    return failing_rows(o, suite, index_col="o_orderkey").select("action", "o_orderkey", "value")


def q_dq_wide_rules(spark, sf):
    """500 components, counted in one scan."""
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    rules = [_rule("page_id", f"number_range({k}, 400)") for k in range(125)]
    rules += [_rule("page_id", f"number_range(2, {k})", "drop") for k in range(125)]
    rules += [_rule("url", f"min_length({k}) or max_length({k // 2})") for k in range(125)]
    suite = compile_rules(spark, rules, pages.schema, as_of=AS_OF)
    return rule_summary(pages, suite).select("expectation", "action", "success", "missing_count", "unexpected_count")


_CSV_NAMES = ["key", "status", "price", "day", "flag", "note"]


def _order_lines(spark, sf) -> DataFrame:
    """orders as CSV lines; of every 97th key one with a field too many, of every 89th one too few."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    fields = F.struct(k.alias("key"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"),
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (k % 2 == 0).alias("flag"),
                      F.concat(F.lit('say "'), "o_orderpriority", F.lit('", or not')).alias("note"))
    line = F.to_csv(fields)
    line = F.when(k % 97 == 0, F.concat(line, F.lit(",x"))).when(k % 89 == 0, F.concat(k.cast("string"), F.lit(",F"))).otherwise(line)
    return o.select(k.alias("o_orderkey"), line.alias("value"))


def q_csv_rows(spark, sf):
    """orders written as CSV lines, types inferred over all accepted lines, parsed."""
    rows = parse_csv_lines(_order_lines(spark, sf), _CSV_NAMES)
    accepted = rows.where(F.col("_rejected").isNull()).drop("_rejected")
    schema = infer_types(accepted.select(*_CSV_NAMES))
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    good = typed(accepted, schema).select("o_orderkey", F.col("key").cast("bigint").alias("key"), "status", "price", _days("day").alias("day"), "flag", "note",
                                          F.lit(",".join(kinds[n] for n in _CSV_NAMES)).alias("kinds"), F.lit(None).cast("string").alias("rejected"))
    bad = rows.where(F.col("_rejected").isNotNull())
    return good.unionByName(bad.select("o_orderkey", F.substring_index("_rejected", ",", 2).alias("rejected")), allowMissingColumns=True)


def _orders_date_text(spark, sf) -> DataFrame:
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = (
        F.when(k % 7 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k % 11 == 0, F.date_format("o_orderdate", "yyyy-M-d"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return o.select("o_orderkey", text.alias("order_date_text"))


def q_dq_date_format(spark, sf):
    rules = [_rule("order_date_text", "date_format(%Y-%m-%d)")]
    return _failing(_orders_date_text(spark, sf), rules, "o_orderkey", spark)


def q_dq_time_format(spark, sf):
    e = read_table(spark, sf, "events")
    text = F.when(F.col("event_id") % 11 == 0, F.date_format("ts", "HH-mm-ss")).otherwise(
        F.date_format("ts", "HH:mm:ss"))
    df = e.select("event_id", text.alias("event_time"))
    return _failing(df, [_rule("event_time", "time_format(%H:%M:%S)")], "event_id", spark)


def q_dq_string_format(spark, sf):
    p = read_table(spark, sf, "pages").select("page_id", "url")
    return _failing(p, [_rule("url", "string_format(^https://)")], "page_id", spark)


def q_dq_data_type(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    e = read_table(spark, sf, "events").select(
        "event_id", F.regexp_replace("props", "[^0-9]", "").alias("props_digits"))
    parts = []
    for table, df, rules in (
        ("orders", o, [_rule("o_totalprice", "data_type(decimal)"),
                       _rule("o_orderkey", "data_type(int)"),
                       _rule("o_orderpriority", "data_type(int)")]),
        ("events", e, [_rule("props_digits", "data_type(int)")]),
    ):
        suite = compile_rules(spark, rules, df.schema, as_of=AS_OF)
        parts.append(component_summary(df, suite).select(
            F.lit(table).alias("table_name"), "column_name", "expectation", "success",
            "missing_count", "unexpected_count", "conforming_count"))
    return parts[0].unionByName(parts[1])


def q_dq_number_range(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return _failing(c, [_rule("c_acctbal", "number_range(0, 5000)")], "c_custkey", spark,
                    with_value=False)


def _report_cols(rep: DataFrame) -> DataFrame:
    return rep.select("table_name", "column_name", "expectation", "action", "success",
                      "missing_count", "unexpected_count", "batch_id")


def q_dq_between(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_quantity")
    suite = compile_rules(spark, [_rule("l_quantity", "number_range(2, 6)")], li.schema, as_of=AS_OF)
    return _report_cols(quality_report(li, suite, "lineitem", "all", PROCESSED_AT))


def q_dq_not_future_datetime(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "ts")
    return _failing(e, [_rule("ts", "not_future_datetime")], "event_id", spark, with_value=False)


def q_dq_not_future_date(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return _failing(o, [_rule("o_orderdate", "not_future_date")], "o_orderkey", spark,
                    with_value=False, as_of=_dt.datetime(2000, 1, 1, 15, 30))


def q_dq_max_length(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return _failing(d, [_rule("text", "max_length(5000)")], "doc_id", spark, with_value=False)


def q_dq_min_length(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return _failing(d, [_rule("text", "min_length(50)")], "doc_id", spark)


def q_dq_string_validation(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_name")
    return _failing(p, [_rule("p_name", "string_validation(ring)")], "p_partkey", spark)


# ---------------------------------------------------------------- combination


def q_dq_component_summary(spark, sf):
    rules = [
        _rule("o_orderstatus", "choice('F','O')"),
        _rule("o_orderpriority", "required and max_length(6)"),
        _rule("o_totalprice", "number_range(1000, 300000)"),
        _rule("o_orderdate", "not_future_date"),
    ]
    df = orders_q(spark, sf)
    suite = compile_rules(spark, rules, df.schema, as_of=_dt.datetime(1999, 1, 1))
    return component_summary(df, suite).select(
        "column_name", "expectation", "component_no", "operator", "rule_name", "success",
        "missing_count", "unexpected_count")


def _verdicts(df: DataFrame, rules: list[dict], spark: SparkSession) -> DataFrame:
    suite = compile_rules(spark, rules, df.schema, as_of=AS_OF)
    return rule_summary(df, suite).select(
        "column_name", "expectation", "success", "missing_count", "unexpected_count")


def q_dq_and(spark, sf):
    e = read_table(spark, sf, "events").select("event_type", "value")
    rules = [
        _rule("event_type", "choice('view','click','purchase') and max_length(5)"),
        _rule("event_type", "max_length(8) and min_length(4)"),
        _rule("value", "number_range(0, 1000) and number_range(5, 50)"),
    ]
    return _verdicts(e, rules, spark)


def q_dq_or(spark, sf):
    e = read_table(spark, sf, "events").select("event_type", "value")
    rules = [
        _rule("event_type", "choice('view','click') or max_length(5)"),
        _rule("event_type", "max_length(8) or choice('x')"),
        _rule("value", "number_range(0, 10) or number_range(10, 100)"),
    ]
    return _verdicts(e, rules, spark)


def q_dq_and_or_precedence(spark, sf):
    e = read_table(spark, sf, "events").select("event_type")
    rules = [
        _rule("event_type", "max_length(8) or choice('view') and min_length(9)"),
        _rule("event_type", "choice('view') and min_length(9) or max_length(8)"),
        _rule("event_type", "choice('view') or max_length(8) and min_length(9)"),
    ]
    return _verdicts(e, rules, spark)


def _document_rules() -> list[dict]:
    return [
        _rule("text", "min_length(50) or max_length(5000)"),
        _rule("lang", "choice('en','de')"),
        _rule("source", "string_format(^src[0-9]$) and max_length(5)"),
    ]


def q_dq_failing_rows(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return _failing(d, _document_rules(), "doc_id", spark)


def q_dq_index_list(spark, sf):
    """The report with every failing row of each failing rule."""
    d = read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    suite = compile_rules(spark, _document_rules(), d.schema, as_of=AS_OF)
    verdicts = rule_summary(d, suite)  # shared by the report and the OR-rule filter
    rep = quality_report(d, suite, "documents", "all", PROCESSED_AT, verdicts=verdicts)
    rows = with_index_rows(rep, failing_rows(d, suite, index_col="doc_id", verdicts=verdicts))
    return rows.select("column_name", "expectation", "success", "unexpected_count", "doc_id", "value")


def q_dq_long_text(spark, sf):
    """string_validation by search on long texts: one literal, one pattern."""
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    rules = [_rule("text", "string_validation(the)"), _rule("text", "string_validation([0-9]{3}-[0-9]{4})")]
    return _failing(d, rules, "doc_id", spark)


def q_dq_unevaluable(spark, sf):
    """D9: rules that can't be evaluated beside good ones; the good ones are
    reported, the others listed with NULL counts."""
    o = read_table(spark, sf, "orders").withColumn("o_day", F.to_date("o_orderdate"))
    rules = [
        _rule("O_ORDERSTATUS", "required and choice('F','O')"),
        _rule("o_day", "number_range(1, 2)"),
        _rule("o_day", "data_type(int)"),
        _rule("o_orderpriority", "string_format([) or max_length(8)"),
        _rule("o_orderpriority", "date_format(%Q)"),
        _rule("o_missing", "required"),
    ]
    _, rep, skipped = check_data_quality(
        1, "tpch", "orders", "b-9", rules=rules, df=o, index_col="o_orderkey", as_of=AS_OF,
        processed_at=PROCESSED_AT, return_skipped=True)
    none = F.lit(None)
    return rep.select("column_name", "expectation", "success", "missing_count", "unexpected_count").unionByName(
        skipped.select("column_name", "expectation", none.cast("boolean").alias("success"),
                       none.cast("bigint").alias("missing_count"), none.cast("bigint").alias("unexpected_count")))


def report_rules() -> list[dict]:
    return [
        _rule("o_orderstatus", "required"),
        _rule("o_orderstatus", "required"),
        _rule("o_orderstatus", "max_length(1)", None),
        _rule("o_orderpriority", "required and choice('1-URGENT','2-HIGH','3-MEDIUM')"),
        _rule("o_totalprice", "number_range(1000, 400000)", "drop"),
        _rule("o_orderdate", "not_future_datetime"),
        _rule("o_custkey", "choice(1,2,3) or number_range(0, 1000)"),
        _rule("o_comment", "required"),
    ]


def q_dq_report(spark, sf):
    df, rep = check_data_quality(
        1, "tpch", "orders", "b-001", rules=report_rules(), df=orders_q(spark, sf),
        index_col="o_orderkey", as_of=_dt.datetime(1999, 6, 30), processed_at=PROCESSED_AT,
    )
    return _report_cols(rep)


def q_dq_catalogue_report(spark, sf):
    """A1 -> D2 -> D11 from a rules DataFrame: the active 'Economy' rules of
    system 2 in the derived catalogue (mixed case, duplicates, unknown names,
    a missing column) checked on ``part``."""
    rules = lookup_rules(rule_catalogue(spark, sf), 2, "Economy")
    part = read_table(spark, sf, "part")
    _, rep = check_data_quality(2, "tpch", "Economy", "b-cat", rules=rules, df=part,
                                index_col="p_partkey", as_of=AS_OF, processed_at=PROCESSED_AT)
    return _report_cols(rep)


def _customer_q(spark, sf) -> DataFrame:
    c = read_table(spark, sf, "customer")
    return c.select(
        "c_custkey", "c_name",
        F.when(F.col("c_custkey") % 17 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


def row_report_rules() -> list[dict]:
    return [
        _rule("c_name", "required"),
        _rule("c_mktsegment", "required and choice('BUILDING','MACHINERY','AUTOMOBILE')"),
        _rule("c_name", "string_format(^Customer#0000000[0-9]{2}$)"),
    ]


def q_dq_row_report(spark, sf):
    df = _customer_q(spark, sf)
    suite = compile_rules(spark, row_report_rules(), df.schema, as_of=AS_OF, expand_required=False)
    return row_report(df, suite, "c_custkey")


def q_dq_row_report_sample(spark, sf):
    df = _customer_q(spark, sf)
    suite = compile_rules(spark, row_report_rules(), df.schema, as_of=AS_OF, expand_required=False)
    return row_report(df, suite, "c_custkey", sample_limit=5)


# ---------------------------------------------------------------- windows


# A low threshold forces the split plan at test scale (events have ~67 rows per
# user, orders ~10 per customer): same results, other plan. Each of its
# partitions but the last ends within or at the end of some key.
HOT = SplitPolicy(hot_rows=8, chunk_rows=5, partitions=24)


def _win(spark, sf, op_fn, policy=DEFAULT_POLICY) -> DataFrame:
    e = _events_value(spark, sf)
    sw = SplitWindow(e, ["user_id"], ["ts", "event_id"], policy)
    out = sw.add(sw.prepare(e), result=op_fn())
    return sw.finish(out).select("event_id", "result")


WINDOW_OPS: dict[str, Callable[[], Op]] = {
    "win_row_number": lambda: RowNumber(),
    "win_first_nonnull": lambda: FirstNonNull(F.col("v")),
    "win_last_nonnull": lambda: LastNonNullUpTo(F.col("v")),
    "win_prev_nonnull": lambda: LastNonNullBefore(F.col("v")),
    "win_lead": lambda: Lead(F.col("v"), 1),
    "win_lag": lambda: Lag(F.col("v"), 1),
    "win_future_any": lambda: LaterNonNull(F.when(F.col("event_type") == "purchase", F.lit(True))),
}


def q_win_future_two(spark, sf, policy=DEFAULT_POLICY):
    e = _events_value(spark, sf).withColumn(
        "flag", (F.col("event_type") == "purchase").cast("int"))
    sw = SplitWindow(e, ["user_id"], ["ts", "event_id"], policy)
    out = sw.add(sw.prepare(e), __n1=Lead(F.col("flag"), 1), __n2=Lead(F.col("flag"), 2))
    result = F.when((F.col("__n1") == 1) | (F.col("__n2") == 1), F.lit(True))
    return sw.finish(out).select("event_id", result.alias("result"))


def _win_query(name: str, policy=DEFAULT_POLICY) -> Query:
    return lambda spark, sf: _win(spark, sf, WINDOW_OPS[name], policy)


# ---------------------------------------------------------------- profiles

PROFILE_ARGS = dict(prefix="Acct", unique_fields=["AccountId"], state_profile="StateProfileId",
                    escheat_date_field_name="EscheatDate",
                    escheat_due_date_field_name="EscheatDueDate", state_profiles_prefix="SP_")


def _profile_input(spark, sf) -> DataFrame:
    return get_escheat_due_date(set_escheat_date(profile_candidates(spark, sf)))


def q_profile_round1(spark, sf):
    r1, _ = profile_stages("Acct", _profile_input(spark, sf), ["AccountId"], "EscheatDate", "SP_",
                           lookback="running")
    return r1.select("AccountId", "SP_ID", _days("eDateToUse").alias("eDateToUse_day"),
                     "Acct_ValidProfile_R1")


def q_profile_round2(spark, sf):
    _, r2 = profile_stages("Acct", _profile_input(spark, sf), ["AccountId"], "EscheatDate", "SP_",
                           lookback="running")
    return r2.select("AccountId", "SP_ID", F.col("RN").cast("bigint").alias("RN"),
                     "Acct_ValidProfile")


def _profile_select(spark, sf, lookback, policy=DEFAULT_POLICY):
    out = set_state_profile(df=profile_candidates(spark, sf), set_escheat_date=set_escheat_date,
                            get_escheat_due_date=get_escheat_due_date, lookback=lookback,
                            policy=policy, **PROFILE_ARGS)
    return out.select("AccountId", "StateProfileId", "Acct_ValidProfile",
                      _days("EscheatDate").alias("escheat_day"),
                      _days("SP_EffectiveDate").alias("effective_day"))


def q_profile_select_running(spark, sf):
    return _profile_select(spark, sf, "running")


def q_profile_select_adjacent(spark, sf):
    return _profile_select(spark, sf, "adjacent")


def q_profile_select_running_hot(spark, sf):
    return _profile_select(spark, sf, "running", HOT)


def q_profile_select_adjacent_hot(spark, sf):
    return _profile_select(spark, sf, "adjacent", HOT)


def q_profile_round2_hot(spark, sf):
    _, r2 = profile_stages("Acct", _profile_input(spark, sf), ["AccountId"], "EscheatDate", "SP_",
                           lookback="running", policy=HOT)
    return r2.select("AccountId", "SP_ID", F.col("RN").cast("bigint").alias("RN"),
                     "Acct_ValidProfile")


QUERIES: dict[str, Query] = {
    "rules_lookup": q_rules_lookup,
    "rules_expand": q_rules_expand,
    "batch_rows": q_batch_rows,
    "row_index": q_row_index,
    "row_index_shuffled": q_row_index_shuffled,
    "batch_of_view": q_batch_of_view,
    "dq_required": q_dq_required,
    "dq_choice": q_dq_choice,
    "dq_choice_large": q_dq_choice_large,
    "dq_wide_rules": q_dq_wide_rules,
    "csv_rows": q_csv_rows,
    "dq_date_format": q_dq_date_format,
    "dq_time_format": q_dq_time_format,
    "dq_string_format": q_dq_string_format,
    "dq_data_type": q_dq_data_type,
    "dq_number_range": q_dq_number_range,
    "dq_between": q_dq_between,
    "dq_not_future_datetime": q_dq_not_future_datetime,
    "dq_not_future_date": q_dq_not_future_date,
    "dq_max_length": q_dq_max_length,
    "dq_min_length": q_dq_min_length,
    "dq_string_validation": q_dq_string_validation,
    "dq_component_summary": q_dq_component_summary,
    "dq_and": q_dq_and,
    "dq_or": q_dq_or,
    "dq_and_or_precedence": q_dq_and_or_precedence,
    "dq_failing_rows": q_dq_failing_rows,
    "dq_index_list": q_dq_index_list,
    "dq_long_text": q_dq_long_text,
    "dq_unevaluable": q_dq_unevaluable,
    "dq_report": q_dq_report,
    "dq_catalogue_report": q_dq_catalogue_report,
    "dq_row_report": q_dq_row_report,
    "dq_row_report_sample": q_dq_row_report_sample,
    **{name: _win_query(name) for name in WINDOW_OPS},
    "win_future_two": q_win_future_two,
    **{f"{name}_hot": _win_query(name, HOT) for name in WINDOW_OPS},
    "win_future_two_hot": lambda spark, sf: q_win_future_two(spark, sf, HOT),
    "profile_round1": q_profile_round1,
    "profile_round2": q_profile_round2,
    "profile_select_running": q_profile_select_running,
    "profile_select_adjacent": q_profile_select_adjacent,
    "profile_round2_hot": q_profile_round2_hot,
    "profile_select_running_hot": q_profile_select_running_hot,
    "profile_select_adjacent_hot": q_profile_select_adjacent_hot,
}
