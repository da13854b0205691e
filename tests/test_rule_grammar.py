"""Random rule texts built from the grammar; the generator knows the answer."""

import random

from tidemark.plans.rules import expand_rules, rules_frame

WORDS = ["salt", "and", "pepper", "or", "A", "b1", "x y", "café"]


def _component(rnd):
    kind = rnd.choice(["required", "choice", "string_format", "date_format", "number_range",
                       "max_length", "min_length", "not_future_date", "data_type",
                       "string_validation", "time_format", "not_future_datetime"])
    if kind in ("required", "not_future_date", "not_future_datetime"):
        return kind, kind, []
    if kind == "choice":
        vals = [rnd.choice(WORDS) for _ in range(rnd.randint(1, 3))]
        return kind, "choice(" + ",".join(f"'{v}'" for v in vals) + ")", vals
    if kind in ("string_format", "string_validation"):
        arg = rnd.choice([r"^[a-z]{2,}$", "x and y", r"a,b", r"\d+ or \w+", "ring"])
        return kind, f"{kind}({arg})", [arg]
    if kind in ("date_format", "time_format"):
        arg = rnd.choice(["%Y-%m-%d", "%H:%M:%S", "%d/%m/%Y"])
        return kind, f"{kind}({arg})", [arg]
    if kind == "number_range":
        a, b = rnd.randint(0, 9), rnd.randint(10, 99)
        return kind, f"number_range({a}, {b})", [str(a), str(b)]
    if kind == "data_type":
        t = rnd.choice(["int", "string", "decimal"])
        return kind, f"data_type({t})", [t]
    n = rnd.randint(1, 50)
    return kind, f"{kind}({n})", [str(n)]


def _rule(rnd):
    comps = [_component(rnd) for _ in range(rnd.randint(1, 4))]
    ops = [None] + [rnd.choice(["and", "or"]) for _ in comps[1:]]
    text = comps[0][1]
    for op, c in zip(ops[1:], comps[1:]):
        text += f" {op} {c[1]}"
    want = []
    for op, (name, _, args) in zip(ops, comps):
        want.append((op, name, args))
        if name == "required":
            want.append(("and", "min_length", ["1"]))
    return text, want


def test_random_rules_expand_to_their_components(spark):
    rnd = random.Random(11)
    cases = {}
    while len(cases) < 150:
        text, want = _rule(rnd)
        cases[text] = want
    df = rules_frame(spark, [{"field_name": "c", "expectation": t, "expectation_action": "warn"}
                             for t in cases])
    got = {}
    for r in expand_rules(df).orderBy("expectation", "component_no").collect():
        got.setdefault(r["expectation"], []).append((r["operator"], r["rule_name"], list(r["args"])))
    assert got == cases


def test_parentheses_inside_arguments(spark):
    """Nested, escaped and unbalanced ones, and those of a character class."""
    cases = {
        "string_format(^a and (b)$)": ["string_format(^a and (b)$)"],
        "string_format(^((a or b) and (c))+$) and required": ["string_format(^((a or b) and (c))+$)", "required"],
        "required or  string_validation((x) or y)\tand max_length(3)": ["required", "string_validation((x) or y)", "max_length(3)"],
        r"string_format(^\(a and (b) or c$) and required": [r"string_format(^\(a and (b) or c$)", "required"],
        "string_format([(] and (x)) or required": ["string_format([(] and (x))", "required"],
        r"string_format([\]( and (]x) or required": [r"string_format([\]( and (]x)", "required"],
        "choice('a(b') and required": ["choice('a(b')", "required"],
        "choice('a)b') or max_length(3)": ["choice('a)b')", "max_length(3)"],
        "required": ["required"],
    }
    df = rules_frame(spark, [{"field_name": "c", "expectation": t, "expectation_action": "warn"} for t in cases])
    got = {}
    for r in expand_rules(df, expand_required=False).orderBy("expectation", "component_no").collect():
        got.setdefault(r["expectation"], []).append((r["operator"], r["component"]))
    assert {t: [c for _, c in v] for t, v in got.items()} == cases
    assert [o for o, _ in got["required or  string_validation((x) or y)\tand max_length(3)"]] == [None, "or", "and"]
