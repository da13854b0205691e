"""Rule catalogue -> components -> compiled suite.

The rule language (``required and max_length(3) or choice('A','B')``) is taken
apart by Spark itself: ``expand_rules`` turns a rules DataFrame - the whole
catalogue, all systems and tables - into one row per component with a fold
over each text's tokens, ``split`` and ``posexplode``. Only the component rows
of the one table being checked are collected (rule metadata, not data) and
compiled into Column predicates.

Decisions on the text form:

* ``and`` / ``or`` split only outside parentheses, so an argument may hold
  them, and further parentheses (``choice('salt and pepper')``,
  ``string_format(^a and (b)$)``). Depth is counted along the text; escaped
  parentheses and those of a character class don't count. Where the text's
  parentheses don't balance (``choice('a(b')``), or it has more than
  ``MAX_FOLDED`` characters, an operator splits unless a ``)`` follows it before
  the next ``(``. ``and`` binds tighter than ``or``.
* a bare ``required`` component expands to ``required and min_length(1)``
  (``expand_required=False`` keeps it alone, as the notebook report does);
* rule names are case-insensitive; ``and`` / ``or`` are lower case;
* a component is ``name`` or ``name(arguments)`` and nothing else: text left
  over (``required foo``, ``required AND ...``) raises ``RuleError``;
* a component that can't be evaluated - its column is missing, its type has no
  such comparison, its pattern is not one - is left out and listed with the
  reason, the rest of the suite is checked;
* a rule whose first name is unknown is skipped (and listed), an unknown name
  later in a rule raises ``RuleError``;
* regex and strftime rules take the whole text up to the last ``)`` as their
  one argument (surrounding quotes removed); the others split on ``,`` and
  drop the quotes.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass, field
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.checks import RULE_NAMES, WHOLE_ARGUMENT_RULES, Check, RuleError, UnevaluableError, build_check
from ..functions.names import col
from ..session import local_frame

SPLIT_PATTERN = r"\s+(?:and|or)\s+(?![^(]*\))"
OPERATOR_PATTERN = r"\s+(and|or)\s+(?![^(]*\))"
JOINT_PATTERN = r"\s+(?:and|or)\s+"
TOKEN_PATTERN = r"(?s)\\.|[()\[\]]|\s+(?:and|or)\s+|[^\\()\[\]\s]+|\s+|\\"
#: Between the parts of a folded text, and between an operator and its component.
_PART, _OPERATOR = "\u0001", "\u0002"
#: Characters of a rule's text up to which parentheses are counted.
MAX_FOLDED = 20_000
COMPONENT_PATTERN = r"(?s)^[A-Za-z_][A-Za-z0-9_]*\s*(\(.*\))?$"
KNOWN_PATTERN = r"(?i)^\s*(" + "|".join(RULE_NAMES) + r")(?![A-Za-z0-9_])"

RULE_COLUMNS = ("field_name", "expectation", "expectation_action")

RULES_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("expectation", T.StringType()),
    T.StructField("expectation_action", T.StringType()),
])


def rules_frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """Rules passed in code (list of dicts) as a DataFrame."""
    rows = [tuple(r.get(f.name) for f in RULES_SCHEMA.fields) for r in rules]
    return local_frame(spark, rows, RULES_SCHEMA)


def lookup_rules(rules: DataFrame, system_id: int, table_name: str) -> DataFrame:
    """Active rules of one table of one source system (case-insensitive name)."""
    return (
        rules.withColumn("table_name", F.lower(F.col("table_name")))
        .where(
            (F.col("table_name") == table_name.lower())
            & (F.col("source_system_id") == F.lit(system_id))
            & (F.col("active") == 1)
            & F.col("expectation").isNotNull()
        )
        .select("table_name", "field_name", "expectation", "expectation_action")
    )


def known_rules(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("expectation").rlike(KNOWN_PATTERN))


def skipped_rules(rules: DataFrame) -> DataFrame:
    """Rules dropped because their text does not start with a known name."""
    return rules.where(~F.coalesce(F.col("expectation").rlike(KNOWN_PATTERN), F.lit(False)))


def _component_struct(operator: Column, text: Column) -> Column:
    return F.struct(operator.alias("operator"), text.alias("component"))


def _balanced_parts(text: Column) -> Column:
    """array<string> of a rule's parts, each with its operator before a mark (the
    first has none); NULL where the parentheses don't balance. A fold over the
    text's tokens - parentheses, brackets, escapes, operators, other text - that
    carries the depth and gives the text back with marks at the outer operators."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("set"), F.lit(True).alias("even"), F.lit("").alias("text"))

    def step(s: Column, token: Column) -> Column:
        inside, counts = s["depth"] > 0, ~s["set"]
        depth = s["depth"] + F.when(counts & (token == "("), 1).when(counts & (token == ")"), -1).otherwise(0)
        outer = ~inside & token.rlike(f"^{JOINT_PATTERN}$")
        return F.struct(
            depth.alias("depth"),
            F.when(s["set"], token != "]").otherwise(inside & (token == "[")).alias("set"),
            (s["even"] & (depth >= 0)).alias("even"),
            F.concat(s["text"], F.when(outer, F.concat(F.lit(_PART), F.trim(F.regexp_replace(token, r"\s+", " ")), F.lit(_OPERATOR))).otherwise(token)).alias("text"),
        )

    tokens = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.aggregate(tokens, start, step, lambda s: F.when(s["even"] & (s["depth"] == 0), F.split(s["text"], _PART)))


def _parts(text: Column) -> Column:
    """array<struct<operator, component>> of a rule's text."""
    plain = ~text.contains(_PART) & ~text.contains(_OPERATOR)
    joined = text.rlike(JOINT_PATTERN)
    balanced = F.transform(_balanced_parts(text), lambda t, i: _component_struct(
        F.when(i > 0, F.substring_index(t, _OPERATOR, 1)), F.trim(F.substring_index(t, _OPERATOR, -1))))
    operators = F.regexp_extract_all(text, F.lit(OPERATOR_PATTERN), 1)
    other = F.transform(F.split(text, SPLIT_PATTERN), lambda t, i: _component_struct(F.when(i > 0, F.get(operators, i - 1)), F.trim(t)))
    # the fold copies the text for each token, so very long texts are split
    return F.when(plain & joined & (F.char_length(text) <= MAX_FOLDED), F.coalesce(balanced, other)).otherwise(other)


def expand_rules(rules: DataFrame, expand_required: bool = True) -> DataFrame:
    """One row per rule component: the rule's columns plus ``component_no``
    (1-based), ``operator`` (NULL for the first), ``component`` (text),
    ``rule_name`` (lower case) and ``args`` (ARRAY<STRING>)."""
    comps = _parts(F.col("expectation"))
    if expand_required:
        extra = _component_struct(F.lit("and"), F.lit("min_length(1)"))
        comps = F.flatten(
            F.transform(
                comps,
                lambda s: F.when(F.lower(s["component"]) == "required", F.array(s, extra))
                .otherwise(F.array(s)),
            )
        )
    exploded = known_rules(rules).select("*", F.posexplode(comps).alias("pos", "c"))
    text = F.col("c.component")
    name = F.lower(F.regexp_extract(text, r"^([A-Za-z_][A-Za-z0-9_]*)", 1))
    inner = F.trim(F.regexp_extract(text, r"(?s)^[^(]*\((.*)\)\s*$", 1))
    whole = F.array(F.regexp_replace(inner, r"(?s)^'(.*)'$", "$1"))
    listed = F.transform(F.split(inner, ","), lambda a: F.trim(F.regexp_replace(a, "'", "")))
    args = (
        F.when(inner == "", F.array().cast("array<string>"))
        .when(name.isin(*WHOLE_ARGUMENT_RULES), whole)
        .otherwise(listed)
    )
    return exploded.select(
        *[c for c in rules.columns],
        (F.col("pos") + 1).cast("int").alias("component_no"),
        F.col("c.operator").alias("operator"),
        text.alias("component"),
        name.alias("rule_name"),
        args.alias("args"),
    )


def _rule_key(rules: list[dict]) -> tuple:
    return tuple((r.get("field_name"), r.get("expectation"), r.get("expectation_action"))
                 for r in rules)


_EXPANDED: dict[tuple, list] = {}


def _expanded_list(spark: SparkSession, key: tuple, expand_required: bool) -> list:
    """Component rows of rules given in code. The expansion depends only on
    the rule texts, so a rule list checked batch after batch is expanded once
    per session."""
    memo = (id(spark), key, expand_required)
    if memo not in _EXPANDED:
        if len(_EXPANDED) >= 256:
            _EXPANDED.clear()
        frame = rules_frame(spark, [dict(zip(RULE_COLUMNS, k)) for k in key])
        _EXPANDED[memo] = expand_rules(frame, expand_required).collect()
    return _EXPANDED[memo]


@dataclass(frozen=True)
class Component:
    no: int
    operator: str | None
    name: str
    args: tuple[str, ...]
    text: str
    check: Check


@dataclass(frozen=True)
class CompiledRule:
    rule_id: int
    column: str
    expectation: str
    action: str | None
    components: tuple[Component, ...]

    def groups(self) -> list[list[Component]]:
        """AND-groups in order; a new group starts at every ``or``."""
        out: list[list[Component]] = []
        for i, comp in enumerate(self.components):
            if i == 0 or comp.operator != "or":
                if not out:
                    out.append([])
                out[-1].append(comp)
            else:
                out.append([comp])
        return out

    def any_fail(self) -> Column:
        """Row-level: the row is unexpected for at least one component."""
        return reduce(lambda a, b: a | b, [c.check.fail for c in self.components])


@dataclass(frozen=True)
class Suite:
    rules: tuple[CompiledRule, ...]
    skipped: tuple[tuple[str, str, str], ...] = field(default=())

    @property
    def components(self) -> list[tuple[CompiledRule, Component]]:
        return [(r, c) for r in self.rules for c in r.components]

    def looked_up(self, df: DataFrame) -> DataFrame:
        """``df`` with the marks that checks on large value sets read: one join
        with each set, whose distinct values are a table of their own."""
        done = set()
        for rule, c in self.components:
            if c.check.lookup is not None and c.check.lookup.mark not in done:
                done.add(c.check.lookup.mark)
                df = c.check.lookup.join(df)
        return df


@lru_cache(1024)
def _regex_problem(spark: SparkSession, pattern: str) -> str | None:
    """Why the session can't use the pattern; evaluated by the planner, no job."""
    try:
        spark.sql("SELECT '' RLIKE :p", args={"p": pattern}).collect()
    except Exception as error:  # noqa: BLE001 - whatever the engine says about the pattern
        return str(error).splitlines()[0][:200]
    return None


def session_clock(spark: SparkSession) -> _dt.datetime:
    """Now, as the session's time zone shows it."""
    return _dt.datetime.fromisoformat(spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0])


def compile_rules(
    spark: SparkSession,
    rules: list[dict] | DataFrame,
    schema: T.StructType,
    as_of: _dt.datetime | None = None,
    expand_required: bool = True,
) -> Suite:
    """Expand the rules with Spark, collect the (small) component rows of the
    distinct rules, and compile each component to predicates over ``schema``.

    Components that can't be evaluated on ``schema`` are left out and listed
    in ``Suite.skipped``; a rule with none left is dropped. Column names match
    as the session matches them. Raises ``RuleError`` for a text that is not a
    rule, and when nothing can be checked.
    """
    if as_of is None:
        as_of = session_clock(spark)
    if isinstance(rules, DataFrame):
        # duplicates say nothing new: one row per distinct rule is expanded and collected
        frame = rules.select(*RULE_COLUMNS).dropDuplicates()
        known = F.coalesce(F.col("expectation").rlike(KNOWN_PATTERN), F.lit(False))
        texts = [r.asDict() for r in frame.withColumn("known", known).collect()]
        unknown = [(r["field_name"], r["expectation"]) for r in texts if not r["known"]]
        rows = _expanded_list(spark, _rule_key([r for r in texts if r["known"]]), expand_required)
    else:
        rows = _expanded_list(spark, _rule_key(rules), expand_required)
        unknown = [(r.get("field_name"), r.get("expectation")) for r in rules
                   if r.get("expectation") is None
                   or not re.match(KNOWN_PATTERN, r["expectation"])]

    by_rule: dict[tuple, dict[int, object]] = {}
    for row in rows:
        key = (row["field_name"], row["expectation"], row["expectation_action"])
        by_rule.setdefault(key, {})[row["component_no"]] = row

    same_case = spark.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda name: name) if same_case else (lambda name: name.lower())
    fields = {fold(f.name): f for f in schema.fields}
    compiled: list[CompiledRule] = []
    skipped: list[tuple[str, str, str]] = [
        (f, e, "no expectation" if e is None else "unknown rule name") for f, e in unknown]
    for key in sorted(by_rule, key=lambda k: tuple("" if v is None else str(v) for v in k)):
        column, expectation, action = key
        comps = []
        for no in sorted(by_rule[key]):
            row = by_rule[key][no]
            name, text = row["rule_name"], row["component"]
            if name not in RULE_NAMES or not re.match(COMPONENT_PATTERN, text):
                raise RuleError(f"rule {expectation!r} on {column!r}: {text!r} is not a rule")
            field = fields.get(fold(column)) if column is not None else None
            args = tuple(row["args"] or ())
            try:
                if field is None:
                    raise UnevaluableError("column not found")
                if name in ("string_format", "string_validation") and args:
                    problem = _regex_problem(spark, args[0])
                    if problem:
                        raise UnevaluableError(f"{name}: {problem}")
                check = build_check(name, args, col(field.name), field.dataType, as_of)
            except UnevaluableError as error:
                if (reason := (column, expectation, str(error))) not in skipped:
                    skipped.append(reason)
                continue
            comps.append(Component(no, row["operator"], name, args, text, check))
        if comps:
            compiled.append(CompiledRule(len(compiled), column, expectation, action, tuple(comps)))
    if not compiled:
        raise RuleError("no rule could be evaluated; check the rules and the columns")
    return Suite(tuple(compiled), tuple(skipped))


def skipped_frame(spark: SparkSession, suite: Suite) -> DataFrame:
    """The rules and components that were left out: column_name, expectation, reason."""
    return local_frame(spark, list(suite.skipped), "column_name string, expectation string, reason string")
