import itertools

import pytest
from pyspark.sql import types as T

from tidemark.functions.checks import RuleError
from tidemark.plans.rules import (
    CompiledRule, Component, compile_rules, expand_rules, lookup_rules, rules_frame,
    skipped_rules,
)


def _expand(spark, texts, **kw):
    df = rules_frame(spark, [{"field_name": "c", "expectation": t, "expectation_action": "warn"}
                             for t in texts])
    rows = expand_rules(df, **kw).orderBy("expectation", "component_no").collect()
    out = {}
    for r in rows:
        out.setdefault(r["expectation"], []).append(
            (r["component_no"], r["operator"], r["rule_name"], list(r["args"])))
    return out


def test_split_outside_parentheses_and_required_expansion(spark):
    got = _expand(spark, [
        "required and choice('salt and pepper') or min_length(3)",
        "Required",
        "string_format(^[a-z]{2,}$) and max_length(5)",
        "choice('A', 'B','C')",
        "not_future_date()",
    ])
    assert got["required and choice('salt and pepper') or min_length(3)"] == [
        (1, None, "required", []),
        (2, "and", "min_length", ["1"]),
        (3, "and", "choice", ["salt and pepper"]),
        (4, "or", "min_length", ["3"]),
    ]
    assert got["Required"] == [(1, None, "required", []), (2, "and", "min_length", ["1"])]
    assert got["string_format(^[a-z]{2,}$) and max_length(5)"] == [
        (1, None, "string_format", ["^[a-z]{2,}$"]),
        (2, "and", "max_length", ["5"]),
    ]
    assert got["choice('A', 'B','C')"] == [(1, None, "choice", ["A", "B", "C"])]
    assert got["not_future_date()"] == [(1, None, "not_future_date", [])]


def test_no_required_expansion(spark):
    got = _expand(spark, ["required"], expand_required=False)
    assert got["required"] == [(1, None, "required", [])]


def test_unknown_first_name_is_skipped(spark):
    df = rules_frame(spark, [
        {"field_name": "c", "expectation": "unknown(1)", "expectation_action": "warn"},
        {"field_name": "c", "expectation": "required_x", "expectation_action": "warn"},
        {"field_name": "c", "expectation": None, "expectation_action": "warn"},
        {"field_name": "c", "expectation": "required", "expectation_action": "warn"},
    ])
    assert expand_rules(df).select("expectation").distinct().collect()[0][0] == "required"
    assert skipped_rules(df).count() == 3


def test_unknown_later_component_raises(spark):
    schema = T.StructType([T.StructField("c", T.StringType())])
    with pytest.raises(RuleError):
        compile_rules(spark, [{"field_name": "c", "expectation": "required and bogus(1)",
                               "expectation_action": "warn"}], schema)


def test_missing_column_rule_dropped_and_all_missing_raises(spark):
    schema = T.StructType([T.StructField("c", T.StringType())])
    suite = compile_rules(spark, [
        {"field_name": "c", "expectation": "required", "expectation_action": "warn"},
        {"field_name": "nope", "expectation": "required", "expectation_action": "warn"},
    ], schema)
    assert [r.column for r in suite.rules] == ["c"]
    assert suite.skipped[0][0] == "nope"
    with pytest.raises(RuleError):
        compile_rules(spark, [{"field_name": "nope", "expectation": "required",
                               "expectation_action": "warn"}], schema)


def test_duplicate_rules_collapse(spark):
    schema = T.StructType([T.StructField("c", T.StringType())])
    r = {"field_name": "c", "expectation": "max_length(3)", "expectation_action": "warn"}
    suite = compile_rules(spark, [r, dict(r)], schema)
    assert len(suite.rules) == 1 and len(suite.rules[0].components) == 1


def test_lookup_rules(spark):
    rows = [
        (1, "Account", "a", "required", "drop", 1),
        (1, "ACCOUNT", "b", "min_length(2)", "warn", 1),
        (1, "account", "c", None, "warn", 1),
        (1, "account", "d", "required", "warn", 0),
        (2, "account", "e", "required", "warn", 1),
        (1, "other", "f", "required", "warn", 1),
    ]
    df = spark.createDataFrame(rows, "source_system_id int, table_name string, field_name string, "
                                     "expectation string, expectation_action string, active int")
    got = sorted(r["field_name"] for r in lookup_rules(df, 1, "AccOunt").collect())
    assert got == ["a", "b"]
    assert set(lookup_rules(df, 1, "account").columns) == {
        "table_name", "field_name", "expectation", "expectation_action"}


def _fold(bools, ops):
    """Reference semantics: the text 'b1 op2 b2 ...' evaluated as Python."""
    expr = str(bools[0])
    for op, b in zip(ops, bools[1:]):
        expr += f" {op} {b}"
    return eval(expr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_and_or_fold_matches_boolean_text(n):
    for ops in itertools.product(["and", "or"], repeat=n - 1):
        comps = tuple(Component(i + 1, None if i == 0 else ops[i - 1], "required", (), "", None)
                      for i in range(n))
        rule = CompiledRule(0, "c", "x", None, comps)
        for bools in itertools.product([True, False], repeat=n):
            got = any(all(bools[c.no - 1] for c in g) for g in rule.groups())
            assert got == _fold(bools, ops), (ops, bools)


def test_skipped_rules_are_listed(spark):
    schema = T.StructType([T.StructField("c", T.StringType())])
    rules = [
        {"field_name": "c", "expectation": "required", "expectation_action": "warn"},
        {"field_name": "c", "expectation": "bogus(1)", "expectation_action": "warn"},
        {"field_name": "c", "expectation": None, "expectation_action": "warn"},
        {"field_name": "gone", "expectation": "required", "expectation_action": "warn"},
    ]
    want = {("c", "bogus(1)", "unknown rule name"), ("c", None, "no expectation"),
            ("gone", "required", "column not found")}
    assert set(compile_rules(spark, rules, schema).skipped) == want
    assert set(compile_rules(spark, rules_frame(spark, rules), schema).skipped) == want
