"""Column checks: one rule name -> row-level predicates.

Each check is two boolean Columns evaluated on every row:

* ``fail``    - the row is *unexpected* for the check;
* ``missing`` - the row is *missing* (NULL) and therefore not judged.

``required`` judges NULLs itself (missing is always false); every other check
treats a NULL as missing, never as unexpected. ``data_type`` is decided from
the schema; it carries a per-row ``conforming`` count beside the verdict.

All predicates are built-in expressions, so a whole rule set compiles into a
single codegen'd projection / aggregate.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame
from .strftime import bad_format, parses_with

# The rule names of the rule language, in their documented order.
RULE_NAMES = (
    "required",
    "not_future_date",
    "not_future_datetime",
    "choice",
    "date_format",
    "time_format",
    "string_format",
    "data_type",
    "number_range",
    "min_length",
    "max_length",
    "string_validation",
)

# Rules whose single argument is the whole text inside the parentheses
# (a regex or a strftime pattern may contain commas).
WHOLE_ARGUMENT_RULES = ("string_format", "string_validation", "date_format", "time_format")

# data_type argument -> expected Spark type.
DATA_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "decimal": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bit": T.BooleanType(),
}

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
# The ranges of the integral types.
_INTEGRAL = {T.ByteType: (-(1 << 7), (1 << 7) - 1), T.ShortType: (-(1 << 15), (1 << 15) - 1),
             T.IntegerType: (-(1 << 31), (1 << 31) - 1), T.LongType: (-(1 << 63), (1 << 63) - 1)}
_DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


#: Values of a ``choice`` up to which they are literals of the plan.
LITERAL_VALUES = 1000
#: Bytes of a value set that are broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Lookup:
    """A large set of allowed values as a table. ``join`` adds the column
    ``mark``, true where ``value`` is in the set; each row is kept once. Beyond
    the broadcast bound Spark may filter the rows' side by a Bloom filter of the
    values (``spark.sql.optimizer.runtime.bloomFilter``)."""

    mark: str
    value: Column
    kind: T.DataType
    values: tuple

    def join(self, df: DataFrame) -> DataFrame:
        schema = T.StructType([T.StructField(f"{self.mark}_v", self.kind), T.StructField(self.mark, T.BooleanType())])
        table = local_frame(df.sparkSession, [(v, True) for v in self.values], schema)
        if sum(len(str(v)) + 32 for v in self.values) <= BROADCAST_BYTES:
            table = F.broadcast(table)
        return df.join(table, self.value == F.col(f"{self.mark}_v"), "left").drop(f"{self.mark}_v")


@dataclass(frozen=True)
class Check:
    fail: Column
    missing: Column
    static_success: bool | None = None
    conforming: Column | None = None
    lookup: Lookup | None = None


class RuleError(ValueError):
    """A rule that cannot be compiled (unknown name, bad arguments)."""


class UnevaluableError(RuleError):
    """A check that cannot be evaluated on its column (a pattern that is not
    one, a type that has no such comparison). The other checks of the suite are
    not affected by it."""


def _as_float(value: str, rule: str) -> float:
    try:
        return float(value)
    except (TypeError, ValueError) as exc:
        raise RuleError(f"{rule}: argument {value!r} is not a number") from exc


def _arity(name: str, args: tuple[str, ...], n: int) -> None:
    if len(args) != n:
        raise RuleError(f"{name} takes {n} argument(s), got {len(args)}: {args!r}")


_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


def _number_like(value: str, dtype: T.DataType) -> int | float | decimal.Decimal | None:
    """A choice value as one of the column's own type; None if that type has no
    such value (it then matches no row)."""
    try:
        number = decimal.Decimal(value)
    except decimal.InvalidOperation:
        return None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(number)
    if not number.is_finite():
        return None
    if isinstance(dtype, T.DecimalType):
        exact = number.quantize(decimal.Decimal(1).scaleb(-dtype.scale), context=decimal.Context(prec=60))
        return exact if exact == number and len(exact.as_tuple().digits) <= dtype.precision else None
    low, high = _INTEGRAL[type(dtype)]
    return int(number) if number == int(number) and low <= number <= high else None


def _can_cast(dtype: T.DataType, to: T.DataType) -> bool:
    """Whether a column of ``dtype`` has a cast to a number, boolean or text."""
    if isinstance(to, T.StringType):
        return True
    if isinstance(dtype, T.TimestampType):
        return True
    return isinstance(dtype, (*_NUMERIC, T.StringType, T.BooleanType, T.VarcharType, T.CharType))


def _castable(dtype: T.DataType, to: T.DataType, name: str) -> None:
    if not _can_cast(dtype, to):
        raise UnevaluableError(f"{name}: a column of type {dtype.simpleString()} has no {to.simpleString()} form")


def _text(c: Column) -> Column:
    return c.cast("string")


def _not_after(c: Column, dtype: T.DataType, bound: str) -> Column:
    """``c > bound`` with the bound typed like the column.

    Typed date/time columns compare as their own type; any other column is
    compared as text, i.e. lexically, like a text bound would be.
    """
    if isinstance(dtype, _DATETIME):
        return c > F.lit(bound).cast(dtype)
    return _text(c) > F.lit(bound)


def build_check(name: str, args: tuple[str, ...], c: Column, dtype: T.DataType,
                as_of: _dt.datetime) -> Check:
    """Compile one rule component against a column of type ``dtype``."""
    present = c.isNotNull()
    missing = c.isNull()

    if name == "required":
        _arity(name, args, 0)
        return Check(fail=c.isNull(), missing=F.lit(False))

    if name == "choice":
        if not args:
            raise RuleError("choice needs at least one value")
        numeric = isinstance(dtype, _NUMERIC)
        if not numeric:
            _castable(dtype, T.StringType(), name)
        values = list(dict.fromkeys(v for v in (_number_like(a, dtype) for a in args) if v is not None) if numeric else dict.fromkeys(args))
        value, kind = (c, dtype) if numeric else (_text(c), T.StringType())
        if len(values) > LITERAL_VALUES:
            digest = hashlib.sha256(repr((str(c), kind, values)).encode()).hexdigest()
            lookup = Lookup(f"__tm_in_{digest[:16]}", value, kind, tuple(values))
            return Check(fail=present & F.col(lookup.mark).isNull(), missing=missing, lookup=lookup)
        ok = value.isin([F.lit(v).cast(kind) for v in values]) if values else F.lit(False)
        return Check(fail=present & ~ok, missing=missing)

    if name in ("date_format", "time_format"):
        _arity(name, args, 1)
        problem = bad_format(args[0])
        if problem:
            raise UnevaluableError(f"{name}: {problem}")
        return Check(fail=present & ~parses_with(c, args[0]), missing=missing)

    if name == "string_format":
        _arity(name, args, 1)
        return Check(fail=present & ~_text(c).rlike(args[0]), missing=missing)

    if name == "string_validation":
        _arity(name, args, 1)
        # a search for the pattern anywhere in the text; plain text needs no regex
        found = _text(c).rlike(args[0]) if _META.search(args[0]) else _text(c).contains(args[0])
        return Check(fail=present & ~found, missing=missing)

    if name == "data_type":
        _arity(name, args, 1)
        expected = DATA_TYPES.get(args[0].lower())
        if expected is None:
            raise RuleError(f"data_type: unknown type {args[0]!r}")
        return Check(
            fail=F.lit(False),
            missing=F.lit(False),
            static_success=(dtype == expected),
            conforming=c.try_cast(expected).isNotNull() if _can_cast(dtype, expected) else F.lit(False),
        )

    if name == "number_range":
        _arity(name, args, 2)
        lo, hi = _as_float(args[0], name), _as_float(args[1], name)
        _castable(dtype, T.DoubleType(), name)
        inside = F.coalesce(c.try_cast("double").between(lo, hi), F.lit(False))
        return Check(fail=present & ~inside, missing=missing)

    if name == "not_future_datetime":
        _arity(name, args, 0)
        bound = str(as_of)  # text form of the clock, as a text column compares
        return Check(fail=present & _not_after(c, dtype, bound), missing=missing)

    if name == "not_future_date":
        _arity(name, args, 0)
        bound = as_of.strftime("%Y-%m-%d 00:00:00")
        return Check(fail=present & _not_after(c, dtype, bound), missing=missing)

    if name == "max_length":
        _arity(name, args, 1)
        n = _as_float(args[0], name)
        return Check(fail=present & (F.length(_text(c)) > n), missing=missing)

    if name == "min_length":
        _arity(name, args, 1)
        n = _as_float(args[0], name)
        return Check(fail=present & (F.length(_text(c)) < n), missing=missing)

    raise RuleError(f"unknown rule {name!r}")
