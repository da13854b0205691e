"""Random frames and random AND/OR rule sets vs a Python brute force of the
rule contracts (NULL is missing except for ``required``; verdicts combine
at data-set level; a failing rule lists the rows failing any component)."""

import random
import re

import pytest

from tidemark.operators.validate import failing_rows, rule_summary
from tidemark.plans.rules import compile_rules

WORDS = ["a", "bb", "ccc", "dddd", "e e", "", "A1"]


def _component(rnd):
    k = rnd.choice(["required", "choice", "max_length", "min_length", "string_format", "number_range"])
    if k == "required":
        return "required", lambda v: v is None, lambda v: False
    if k == "choice":
        vals = rnd.sample(WORDS, 2)
        text = "choice(" + ",".join(f"'{x}'" for x in vals) + ")"
        return text, lambda v, vals=vals: v is not None and v not in vals, lambda v: v is None
    if k in ("max_length", "min_length"):
        n = rnd.randint(0, 4)
        op = (lambda v, n=n: len(v) > n) if k == "max_length" else (lambda v, n=n: len(v) < n)
        return f"{k}({n})", lambda v, op=op: v is not None and op(v), lambda v: v is None
    if k == "string_format":
        pat = rnd.choice([r"^[a-z]+$", r"\d", r"^.{2,3}$"])
        return (f"string_format({pat})", lambda v, p=pat: v is not None and not re.search(p, v),
                lambda v: v is None)
    lo, hi = sorted(rnd.sample(range(0, 5), 2))

    def bad(v, lo=lo, hi=hi):
        if v is None:
            return False
        try:
            return not (lo <= float(v) <= hi)
        except ValueError:
            return True
    return f"number_range({lo}, {hi})", bad, lambda v: v is None


MIN1 = ("min_length(1)", lambda v: v is not None and len(v) < 1, lambda v: v is None)


def _rule(rnd):
    comps = [_component(rnd) for _ in range(rnd.randint(1, 4))]
    ops = [None] + [rnd.choice(["and", "or"]) for _ in comps[1:]]
    text = comps[0][0] + "".join(f" {o} {c[0]}" for o, c in zip(ops[1:], comps[1:]))
    # a bare `required` stands for `required and min_length(1)`
    full_comps, full_ops = [], []
    for c, o in zip(comps, ops):
        full_comps.append(c)
        full_ops.append(o)
        if c[0] == "required":
            full_comps.append(MIN1)
            full_ops.append("and")
    return text, full_comps, full_ops


def _expected(values, comps, ops):
    fails = [[c[1](v) for v in values] for c in comps]
    passed = [not any(f) for f in fails]
    groups = [[passed[0]]]
    for op, p in zip(ops[1:], passed[1:]):
        if op == "or":
            groups.append([p])
        else:
            groups[-1].append(p)
    success = any(all(g) for g in groups)
    missing = sum(sum(c[2](v) for v in values) for c in comps)
    bad_rows = [i for i in range(len(values)) if any(f[i] for f in fails)]
    return success, missing, (0 if success else len(bad_rows)), ([] if success else bad_rows)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_random_rules_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    values = [None if rnd.random() < 0.15 else rnd.choice(WORDS + ["1", "3", "7", "x9"])
              for _ in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string")
    rules, want = [], {}
    while len(rules) < 12:
        text, comps, ops = _rule(rnd)
        if text in want:
            continue
        rules.append({"field_name": "c", "expectation": text, "expectation_action": "warn"})
        want[text] = _expected(values, comps, ops)
    suite = compile_rules(spark, rules, df.schema)
    got = {r["expectation"]: (r["success"], r["missing_count"], r["unexpected_count"])
           for r in rule_summary(df, suite).collect()}
    assert got == {t: w[:3] for t, w in want.items()}
    rows = {}
    for r in failing_rows(df, suite, index_col="id").collect():
        rows.setdefault(r["expectation"], []).append(r["id"])
    assert {t: sorted(v) for t, v in rows.items()} == {t: w[3] for t, w in want.items() if w[3]}


def _int_component(rnd):
    k = rnd.choice(["required", "choice", "max_length", "number_range", "string_format"])
    if k == "required":
        return "required", lambda v: v is None, lambda v: False
    if k == "choice":
        vals = rnd.sample(range(-2, 8), 3)
        text = "choice(" + ",".join(str(x) for x in vals) + ",'x')"
        return text, lambda v, vals=vals: v is not None and v not in vals, lambda v: v is None
    if k == "max_length":
        n = rnd.randint(1, 2)
        return f"max_length({n})", lambda v, n=n: v is not None and len(str(v)) > n, lambda v: v is None
    if k == "string_format":
        return ("string_format(^-)", lambda v: v is not None and not str(v).startswith("-"),
                lambda v: v is None)
    lo, hi = sorted(rnd.sample(range(-2, 12), 2))
    return (f"number_range({lo}, {hi})", lambda v, lo=lo, hi=hi: v is not None and not lo <= v <= hi,
            lambda v: v is None)


@pytest.mark.parametrize("seed", [5, 6])
def test_random_rules_on_an_int_column(spark, seed):
    rnd = random.Random(seed)
    values = [None if rnd.random() < 0.15 else rnd.randint(-3, 120) for _ in range(50)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c int")
    rules, want = [], {}
    while len(rules) < 10:
        comps = [_int_component(rnd) for _ in range(rnd.randint(1, 3))]
        ops = [None] + [rnd.choice(["and", "or"]) for _ in comps[1:]]
        text = comps[0][0] + "".join(f" {o} {c[0]}" for o, c in zip(ops[1:], comps[1:]))
        if text in want:
            continue
        full_comps, full_ops = [], []
        for c, o in zip(comps, ops):
            full_comps.append(c)
            full_ops.append(o)
            if c[0] == "required":
                full_comps.append(("min_length(1)", lambda v: v is not None and len(str(v)) < 1,
                                   lambda v: v is None))
                full_ops.append("and")
        rules.append({"field_name": "c", "expectation": text, "expectation_action": "warn"})
        want[text] = _expected(values, full_comps, full_ops)
    suite = compile_rules(spark, rules, df.schema)
    got = {r["expectation"]: (r["success"], r["missing_count"], r["unexpected_count"])
           for r in rule_summary(df, suite).collect()}
    assert got == {t: w[:3] for t, w in want.items()}
