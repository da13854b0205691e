"""Validation: summaries, rule report, failing rows, row report.

Physical shape, whatever the number of rules:

* every count (unexpected, missing, conforming per component; distinct
  failing rows per rule) comes from **one** scan of the table - partial
  aggregates per task, a single tiny merge. Up to ``MAX_AGGREGATED`` components
  are columns of one ``agg``. With more, whose columns generated code could not
  hold, a row emits the numbers of the marks that it sets (a component fails, a
  column is missing, ...), and one aggregate counts by number: rules as data;
* failing rows come from **one** narrow projection: every row emits one
  ``(rule, value)`` struct per failing rule via ``explode(filter(array(...)))``
  - no shuffle, no per-rule job. Only rules with ``or`` need their verdicts
  (they can pass with failing rows): those are dropped by an anti join
  against the passing ones (one row per rule, broadcast).

AND/OR is combined at data-set level, as the checks are: a rule ``A or B``
fails when both components have unexpected rows, even if they are different
rows; its failing rows are then the union (rows failing any component).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import col
from ..plans.rules import CompiledRule, Suite, compile_rules, lookup_rules, skipped_frame
from ..session import local_frame
from .row_index import with_row_index

#: Components up to which the counts are columns of one aggregate.
MAX_AGGREGATED = 200


def _lit_str(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _is_wide(suite: Suite) -> bool:
    """More components than one aggregate has columns for."""
    return len(suite.components) > MAX_AGGREGATED


def _set_marks(marks: list[Column]) -> Column:
    """One row for each mark (NULL where it isn't set) that the input row sets."""
    return F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull()))


def _u(r, c):
    return f"u_{r.rule_id}_{c.no}"


def _m(r, c):
    return f"m_{r.rule_id}_{c.no}"


def _k(r, c):
    return f"k_{r.rule_id}_{c.no}"


def _a(r):
    return f"a_{r.rule_id}"


def _aggregate(df: DataFrame, rules: tuple[CompiledRule, ...]) -> DataFrame:
    """One-row frame with every count of the given rules (one scan)."""
    aggs: list[Column] = []
    for r in rules:
        for c in r.components:
            aggs.append(F.count_if(c.check.fail).alias(_u(r, c)))
            aggs.append(F.count_if(c.check.missing).alias(_m(r, c)))
            if c.check.conforming is not None:
                aggs.append(F.count_if(c.check.conforming).alias(_k(r, c)))
        if len(r.components) > 1:
            aggs.append(F.count_if(r.any_fail()).alias(_a(r)))
    return df.agg(*aggs)


def _success_sql(r: CompiledRule, c) -> str:
    if c.check.static_success is not None:
        return "true" if c.check.static_success else "false"
    return f"({_u(r, c)} = 0)"


def _rule_success_sql(r: CompiledRule) -> str:
    ands = [" AND ".join(_success_sql(r, c) for c in g) for g in r.groups()]
    return "(" + " OR ".join(f"({a})" for a in ands) + ")"


# The per-rule / per-component rows are built as one SQL expression over the
# aggregate's own column names (numbers only; texts join in from a small
# local frame): a handful of JVM calls instead of hundreds.


def _rule_rows(rules: tuple[CompiledRule, ...]) -> Column:
    rows = []
    for r in rules:
        success = _rule_success_sql(r)
        failing = _a(r) if len(r.components) > 1 else _u(r, r.components[0])
        missing = " + ".join(_m(r, c) for c in r.components)
        rows.append(
            f"named_struct('rule_id', {r.rule_id}, 'success', {success}, "
            f"'missing_count', CAST({missing} AS BIGINT), "
            f"'unexpected_count', CAST(CASE WHEN {success} THEN 0 ELSE {failing} END AS BIGINT))"
        )
    return F.expr(f"inline(array({', '.join(rows)}))")


def _component_rows(rules: tuple[CompiledRule, ...]) -> Column:
    rows = []
    for r in rules:
        for c in r.components:
            conforming = _k(r, c) if c.check.conforming is not None else "NULL"
            rows.append(
                f"named_struct('rule_id', {r.rule_id}, 'component_no', {c.no}, "
                f"'success', {_success_sql(r, c)}, "
                f"'missing_count', CAST({_m(r, c)} AS BIGINT), "
                f"'unexpected_count', CAST({_u(r, c)} AS BIGINT), "
                f"'conforming_count', CAST({conforming} AS BIGINT))"
            )
    return F.expr(f"inline(array({', '.join(rows)}))")


def _rule_meta(df: DataFrame, suite: Suite) -> DataFrame:
    rows = [(r.rule_id, r.column, r.expectation, r.action) for r in suite.rules]
    return local_frame(df.sparkSession, rows,
                       "rule_id int, column_name string, expectation string, action string")


def _component_meta(df: DataFrame, suite: Suite) -> DataFrame:
    rows = [(r.rule_id, c.no, r.column, r.expectation, r.action, c.operator, c.name)
            for r, c in suite.components]
    return local_frame(df.sparkSession, rows,
                       "rule_id int, component_no int, column_name string, expectation string, "
                       "action string, operator string, rule_name string")


_MARKS = "mark int, kind string, rule_id int, component_no int, group_no int, static boolean"


def _marked_counts(df: DataFrame, suite: Suite) -> DataFrame:
    """(rule_id, component_no, group_no, static, u, m, k, a) of a wide suite:
    failing, missing and conforming rows of each component, rows that fail any
    component of its rule (with the rule's first one). One scan, one shuffle of
    at most a row per mark and task."""
    marks: dict[tuple, int] = {}
    tests: list[Column] = []
    rows = []

    def mark(key: tuple, test: Column, kind: str, r, c, group: int) -> None:
        if key not in marks:
            marks[key] = len(tests)
            tests.append(F.when(test, F.lit(len(tests))))
        rows.append((marks[key], kind, r.rule_id, c.no, group, c.check.static_success))

    for r in suite.rules:
        for group, comps in enumerate(r.groups()):
            for c in comps:
                key = (r.column, c.name, c.args)
                mark(("u", *key), c.check.fail, "u", r, c, group)
                if c.name not in ("required", "data_type"):  # which call no row missing
                    mark(("m", r.column), c.check.missing, "m", r, c, group)
                if c.check.conforming is not None:
                    mark(("k", *key), c.check.conforming, "k", r, c, group)
        if len(r.components) > 1:
            mark(("a", r.rule_id), r.any_fail(), "a", r, r.components[0], 0)
    counts = df.select(_set_marks(tests).alias("set")).groupBy("set").agg(F.count(F.lit(1)).alias("n"))
    of = F.broadcast(local_frame(df.sparkSession, rows, _MARKS))  # as many rows as the suite has
    joined = counts.join(of, F.col("set") == F.col("mark"), "right").withColumn("n", F.coalesce("n", F.lit(0)))
    total = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")))
    zero = F.lit(0).cast("bigint")
    return joined.groupBy("rule_id", "component_no", "group_no", "static").agg(
        F.coalesce(total("u"), zero).alias("u"), F.coalesce(total("m"), zero).alias("m"), total("k").alias("k"), total("a").alias("a"))


def _wide_component_rows(df: DataFrame, suite: Suite) -> DataFrame:
    return _marked_counts(df, suite).select(
        "rule_id", "component_no", F.coalesce("static", F.col("u") == 0).alias("success"), F.col("m").alias("missing_count"),
        F.col("u").alias("unexpected_count"), F.col("k").alias("conforming_count"))


def _wide_rule_rows(df: DataFrame, suite: Suite) -> DataFrame:
    groups = _marked_counts(df, suite).groupBy("rule_id", "group_no").agg(
        F.every(F.coalesce("static", F.col("u") == 0)).alias("all"), F.sum("m").alias("m"), F.max("a").alias("a"), F.max("u").alias("u"))
    rules = groups.groupBy("rule_id").agg(F.some("all").alias("success"), F.sum("m").alias("m"), F.max(F.coalesce("a", F.lit(-1))).alias("a"), F.max("u").alias("u"))
    failing = F.when(F.col("a") >= 0, F.col("a")).otherwise(F.col("u"))
    return rules.select("rule_id", "success", F.col("m").cast("bigint").alias("missing_count"),
                        F.when(F.col("success"), F.lit(0)).otherwise(failing).cast("bigint").alias("unexpected_count"))


def component_summary(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per component: success, missing_count, unexpected_count
    (plus conforming_count for ``data_type``)."""
    df = suite.looked_up(df)
    counts = _wide_component_rows(df, suite) if _is_wide(suite) else _aggregate(df, suite.rules).select(_component_rows(suite.rules))
    return F.broadcast(_component_meta(df, suite)).join(counts, ["rule_id", "component_no"]).select(
        "rule_id", "component_no", "column_name", "expectation", "action", "operator",
        "rule_name", "success", "missing_count", "unexpected_count", "conforming_count")


def rule_summary(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per rule, AND/OR combined (``rule_id`` kept for joins)."""
    df = suite.looked_up(df)
    counts = _wide_rule_rows(df, suite) if _is_wide(suite) else _aggregate(df, suite.rules).select(_rule_rows(suite.rules))
    return F.broadcast(_rule_meta(df, suite)).join(counts, "rule_id").select(
        "rule_id", "column_name", "expectation", "action", "success", "missing_count",
        "unexpected_count")


def quality_report(
    df: DataFrame,
    suite: Suite,
    table_name: str | None = None,
    batch_id: str | None = None,
    processed_at: _dt.datetime | None = None,
    verdicts: DataFrame | None = None,
) -> DataFrame:
    """The rule report: table_name, column_name, expectation, action, success,
    missing_count, unexpected_count, proccesed_datetime, batch_id.
    ``verdicts`` may pass an already built ``rule_summary``."""
    stamp = F.lit(processed_at) if processed_at is not None else F.current_timestamp()
    if verdicts is None:
        verdicts = rule_summary(df, suite)
    return verdicts.select(
        _lit_str(table_name).alias("table_name"),
        "column_name", "expectation", "action", "success",
        "missing_count", "unexpected_count",
        stamp.alias("proccesed_datetime"),
        _lit_str(batch_id).alias("batch_id"),
    )


def failing_rows(
    df: DataFrame,
    suite: Suite,
    index_col: str = "RowIndex",
    verdicts: DataFrame | None = None,
) -> DataFrame:
    """Long form of the failing rows of every failing rule:
    column_name, expectation, action, <index_col>, value (as text).

    One row per (rule, row): a row failing several components of a rule is
    listed once. A rule without ``or`` fails exactly when some row fails one
    of its components, so its rows need no verdict; only rules with ``or``
    (which may pass with failing rows) are checked against their verdicts -
    computed for those rules alone, or taken from ``verdicts``. A rule set
    without ``or`` is therefore a single narrow pass.
    """

    structs = [
        F.when(r.any_fail(), F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            col(r.column).cast("string").alias("value"),
        ))
        for r in suite.rules
    ]
    long = suite.looked_up(df).select(col(index_col), _set_marks(structs).alias("v")).select("v.rule_id", col(index_col), "v.value")
    with_or = [r for r in suite.rules if any(c.operator == "or" for c in r.components)]
    if with_or:
        if verdicts is None:
            verdicts = rule_summary(df, Suite(tuple(with_or)))
        # one row per rule: size bounded by the rule count, safe to broadcast
        passed = verdicts.where(F.col("success")).select("rule_id")
        long = long.join(F.broadcast(passed), "rule_id", "left_anti")
    return (
        long.join(F.broadcast(_rule_meta(df, suite)), "rule_id")
        .select("column_name", "expectation", "action", col(index_col), "value")
    )


def with_index_rows(report: DataFrame, failing: DataFrame) -> DataFrame:
    """The report in long form: each rule's row, once for each of its failing
    rows (index and value), or once with NULLs if it has none. Complete, and
    without a group per rule: the report, one row per rule, is broadcast."""
    keys = ["column_name", "expectation", "action"]
    cols = [c for c in failing.columns if c not in keys]
    r = F.broadcast(report.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                                  *[col(c) for c in report.columns if c not in keys]))
    # NULL action is a group of its own: match keys null-safely
    cond = reduce(lambda a, b: a & b, [failing[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    order = [col(c) for c in report.columns]
    listed = failing.join(r, cond).select(*order, *[col(c) for c in cols])
    # rules without failing rows pass, by construction, or are decided from the schema
    quiet = report.where(F.col("success") | (F.col("unexpected_count") == 0)).select(
        *order, *[F.lit(None).cast(failing.schema[c].dataType).alias(c) for c in cols])
    return listed.unionByName(quiet)


def row_report(
    df: DataFrame,
    suite: Suite,
    id_col: str,
    sample_limit: int | None = None,
) -> DataFrame:
    """Row-level failure report, one check at a time (no AND/OR combination):
    expectation_type, column, status, unexpected_count, unexpected_value, <id_col>.

    A failing check gives one row per failing row (value and id from the same
    row); a passing check (or a schema-only check) gives one row with NULLs.
    ``sample_limit`` keeps the first n failing rows per check by id.
    """
    keys = ["rule_id", "component_no"]
    # One count per data check (one scan, metadata back to the driver);
    # schema-only checks need no data. The verdicts then feed both halves of
    # the report, keeping the data to two scans.
    tested = [(r, c) for r, c in suite.components if c.check.static_success is None]
    id_type = df.schema[id_col].dataType
    df = suite.looked_up(df)
    counts = {}
    if tested and _is_wide(suite):
        numbers = [F.when(c.check.fail, F.lit(i)) for i, (_, c) in enumerate(tested)]
        found = df.select(_set_marks(numbers).alias("set")).groupBy("set").count().collect()  # at most a row per component
        counts = {_u(*tested[x["set"]]): x["count"] for x in found}
    elif tested:
        counts = df.agg(*[F.count_if(c.check.fail).alias(_u(r, c)) for r, c in tested]).collect()[0].asDict()
    head_rows = []
    for r, c in suite.components:
        static = c.check.static_success
        failing = counts.get(_u(r, c), 0)
        status = static if static is not None else failing == 0
        head_rows.append((r.rule_id, c.no, c.name, r.column, status, failing, static is not None))
    head = local_frame(df.sparkSession, head_rows,
                       "rule_id int, component_no int, expectation_type string, column string, "
                       "status boolean, unexpected_count bigint, schema_only boolean")
    quiet = head.where(F.col("status") | F.col("schema_only")).select(
        "expectation_type", "column", "status",
        F.when(F.col("status"), F.lit(0)).otherwise(F.col("unexpected_count")).cast("bigint")
        .alias("unexpected_count"),
        F.lit(None).cast("string").alias("unexpected_value"),
        F.lit(None).cast(id_type).alias(id_col),
    )
    if not tested:
        return quiet
    structs = [
        F.when(c.check.fail, F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(c.no).alias("component_no"),
            col(r.column).cast("string").alias("unexpected_value"),
        ))
        for r, c in tested
    ]
    details = df.select(col(id_col), _set_marks(structs).alias("v")).select(
        "v.rule_id", "v.component_no", "v.unexpected_value", col(id_col))
    if sample_limit is not None:
        w = Window.partitionBy(*keys).orderBy(col(id_col))
        details = details.withColumn("__rn", F.row_number().over(w)).where(
            F.col("__rn") <= sample_limit).drop("__rn")
    # one row per component: bounded by the rule set, safe to broadcast
    failed = head.where(~F.col("status") & ~F.col("schema_only"))
    failing = details.join(F.broadcast(failed), keys).select(
        "expectation_type", "column", "status", "unexpected_count", "unexpected_value", col(id_col))
    return failing.unionByName(quiet)


def check_data_quality(
    system_id: int,
    system_name: str,
    table_name: str,
    batch_id: str,
    rules: list[dict] | DataFrame | None = None,
    df: DataFrame | None = None,
    *,
    spark: SparkSession | None = None,
    rules_table: str | None = None,
    catalog: str | None = None,
    schema: str | None = None,
    index_col: str = "RowIndex",
    as_of: _dt.datetime | None = None,
    processed_at: _dt.datetime | None = None,
    index_rows: bool = False,
    number_rows: bool = True,
    return_skipped: bool = False,
) -> tuple[DataFrame, ...]:
    """End-to-end check of one batch of one table.

    Rules: ``rules`` (list of dicts or DataFrame) or, when empty, the active
    rules of ``table_name`` / ``system_id`` in ``rules_table``. Data: ``df``
    or the batch ``batch_id`` of ``{catalog}.{schema}.{system}_{table}``.

    The report always reads the caller's own frame, only the ruled columns.
    A missing ``index_col`` is added as 1..n in physical order, for the frame
    that is returned and for ``index_rows``; a frame that is more than a scan
    (see ``with_row_index``) is written once for that. ``number_rows=False``
    returns the frame as it is, and nothing is written.

    ``index_rows=True`` gives the report in long form, with ``index_col`` and
    value of every failing row of each failing rule.

    Returns (frame, report), with ``return_skipped=True`` (frame, report,
    skipped), skipped being the rules that couldn't be evaluated, with reasons.
    """
    if spark is None:
        spark = (df.sparkSession if df is not None else SparkSession.getActiveSession())
    if rules is None or (isinstance(rules, list) and not rules):
        if rules_table is None:
            raise ValueError("no rules given and no rules_table to read them from")
        rules = lookup_rules(spark.read.table(rules_table), system_id, table_name)
    if df is None:
        from ..sources.tables import read_batch

        full_name = f"{system_name.lower()}_{table_name.lower()}"
        qualified = ".".join(p for p in (catalog, schema, full_name) if p)
        df = read_batch(spark, qualified, batch_id, index_col=None)
    suite = compile_rules(spark, rules, df.schema, as_of=as_of)
    verdicts = rule_summary(df, suite)
    report = quality_report(df, suite, table_name=table_name, batch_id=batch_id,
                            processed_at=processed_at, verdicts=verdicts)
    out = df
    if index_col not in df.columns and (number_rows or index_rows):
        out = with_row_index(df, index_col)
    if index_rows:
        # the same verdicts feed the report and the OR-rule filter: one aggregate
        report = with_index_rows(report, failing_rows(out, suite, index_col=index_col, verdicts=verdicts))
    return (out, report, skipped_frame(spark, suite)) if return_skipped else (out, report)
