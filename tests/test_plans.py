"""Plan shapes that carry the scale properties (checked with explain)."""

import contextlib
import io
import re

from tidemark.operators.profiles import set_state_profile
from tidemark.operators.row_index import with_row_index
from tidemark.operators.validate import failing_rows, quality_report, row_report
from tidemark.plans import queries as Q
from tidemark.plans.rules import compile_rules

SF = "/root/testdata/sf0.01"


def _plan(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _orders_suite(spark, rules):
    df = Q.orders_q(spark, SF)
    return df, compile_rules(spark, rules, df.schema, as_of=Q.AS_OF)


def test_report_is_one_aggregate_over_pruned_columns(spark):
    df, suite = _orders_suite(spark, Q.report_rules()[:-1])
    plan = _plan(quality_report(df, suite))
    assert plan.count("Exchange SinglePartition") == 1
    assert "Exchange hashpartitioning" not in plan
    # a rule on one column reads that column only
    df, suite = _orders_suite(spark, [Q._rule("o_orderstatus", "required")])
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", _plan(quality_report(df, suite), "formatted"))
    assert schemas == ["struct<o_orderstatus:string>"]


def test_failing_rows_without_or_rules_do_not_shuffle(spark):
    df, suite = _orders_suite(spark, [Q._rule("o_orderstatus", "required"),
                                      Q._rule("o_orderpriority", "max_length(6)")])
    plan = _plan(failing_rows(df, suite, index_col="o_orderkey"))
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan


def test_sampled_row_report_limits_before_the_shuffle(spark):
    df, suite = _orders_suite(spark, [Q._rule("o_orderpriority", "choice('1-URGENT')")])
    plan = _plan(row_report(df, suite, "o_orderkey", sample_limit=3))
    assert "WindowGroupLimit" in plan


def test_profile_chain_has_one_exchange_on_the_record(spark):
    out = set_state_profile(df=Q.profile_candidates(spark, SF), set_escheat_date=Q.set_escheat_date,
                            get_escheat_due_date=Q.get_escheat_due_date, **Q.PROFILE_ARGS)
    plan = _plan(out)
    assert len(re.findall(r"Exchange hashpartitioning\(AccountId", plan)) == 1
    assert "SinglePartition" not in plan


def test_row_numbers_broadcast_partition_offsets(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _plan(with_row_index(df))
    assert "BroadcastHashJoin" in plan
    # the data itself is never moved into one partition
    assert not re.search(r"Window \[row_number\(\)", plan)


def test_batch_filter_reaches_the_scan(spark):
    from tidemark.sources.tables import read_batch

    spark.read.parquet(f"{SF}/events.parquet").createOrReplaceTempView("tm_bronze_events")
    df = read_batch(spark, "tm_bronze_events", "3", batch_col="user_id", index_col=None)
    plan = _plan(df.select("event_id", "event_type"), "formatted")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(user_id,3\)", plan)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_split_profile_chain_reads_the_source_once(spark):
    out = set_state_profile(df=Q.profile_candidates(spark, SF), set_escheat_date=Q.set_escheat_date,
                            get_escheat_due_date=Q.get_escheat_due_date, policy=Q.HOT,
                            **Q.PROFILE_ARGS)
    plan = _plan(out)
    # the rounds start from the rows that were written with their partition's number
    assert "FileScan parquet" not in plan
    assert not re.search(r"Exchange hashpartitioning\(AccountId#\d+L?, __tm_chunk", plan)
    assert "SinglePartition" not in plan
    # one exchange of the rows for all rounds, one of the picked rows' keys
    assert len(re.findall(r"Exchange shufflepartitionidpassthrough", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
