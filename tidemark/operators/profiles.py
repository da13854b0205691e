"""Profile selection: the one applicable profile per record.

Input: one row per (record, candidate profile); record columns and the
profile's columns (``{P}EffectiveDate``, ``{P}ProfileId``,
``{P}EffectiveDateType``, ``{P}ID``) side by side, with ``SoldDate`` and
``ReplacementDate`` and an escheat date column.

Two look-back modes that give different winners:

* ``running``  - a later round-1 valid row demotes *every* earlier row; the
  "previous escheat date" is the last non-null one before the row; an invalid
  row invalidates *all* its followers;
* ``adjacent`` - only the next row demotes; the previous escheat date is the
  plain previous row's (NULLs kept); an invalid row invalidates only the next.

Plan: every window is on the same (record keys, effective date, profile id)
spec, so the chain is one hash exchange on the record keys and one sort; the
final pick is ``row_number() = 1`` on that same partitioning (no second
exchange); a partial group limit keeps one row per key before any shuffle of
split keys. ``pick="max_by"`` is the same as an aggregate. Order ties are broken
by ``{P}ID``. When a record has more than ``policy.hot_rows`` candidates, the
windows run as segmented scans over range partitions (``split_window``).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import col
from .split_window import (
    CHUNK, DEFAULT_POLICY, FirstNonNull, Lag, LastNonNullBefore, LastNonNullUpTo, Lead,
    LaterNonNull, RowNumber, SplitPolicy, SplitWindow, TIE,
)

# The effective-date type that gets the round-1 check.
SOLD_ON_OR_AFTER = "SOLDONORAFTER"
LOOKBACKS = ("running", "adjacent")


class _Names:
    def __init__(self, prefix: str, sp: str, escheat: str):
        self.eff = f"{sp}EffectiveDate"
        self.pid = f"{sp}ProfileId"
        self.typ = f"{sp}EffectiveDateType"
        self.id = f"{sp}ID"
        self.esc = escheat
        self.r1 = f"{prefix}_ValidProfile_R1"
        self.valid = f"{prefix}_ValidProfile"


def _order(n: _Names) -> list[str]:
    return [n.eff, n.pid, n.id]


def profile_round1(df: DataFrame, sw: SplitWindow, n: _Names, lookback: str) -> DataFrame:
    """F2-F4: eDateToUse, round-1 flag, demotion by later valid rows."""
    eff = col(n.eff)
    flag = F.when(
        col(n.typ) == SOLD_ON_OR_AFTER,
        F.when(
            (eff <= F.col("SoldDate"))
            | (F.col("ReplacementDate").isNotNull() & (eff <= F.col("ReplacementDate"))),
            F.lit(1),
        ).otherwise(F.lit(0)),
    )
    out = df.withColumn("__tm_r1", flag)
    valid_mark = F.when(F.col("__tm_r1") == 1, F.lit(1))
    demote_op = LaterNonNull(valid_mark) if lookback == "running" else Lead(valid_mark, 1)
    out = sw.add(out, eDateToUse=FirstNonNull(col(n.esc)), __tm_demote=demote_op)
    r1 = F.when(F.col("__tm_demote").isNotNull(), F.lit(0)).otherwise(F.col("__tm_r1"))
    cols = [c for c in out.columns if c not in ("__tm_r1", "__tm_demote", "eDateToUse")]
    return out.select(*cols, "eDateToUse", r1.alias(n.r1))


def profile_round2(df: DataFrame, sw: SplitWindow, n: _Names, lookback: str) -> DataFrame:
    """F5-F7: drop demoted rows, number the rest, round-2 flag, invalidation."""
    r1, eff, esc = col(n.r1), col(n.eff), col(n.esc)
    kept = sw.add(df.where(r1.isNull() | (r1 == 1)), RN=RowNumber())
    kept = kept.where((r1 == 1) | (F.col("RN") == 1) | esc.isNull() | (eff <= esc))
    if lookback == "running":
        prev = dict(__tm_upto=LastNonNullUpTo(esc), __tm_before=LastNonNullBefore(esc))
    else:
        prev = dict(__tm_upto=Lag(esc, 1))
    kept = sw.add(kept, **prev)
    prev_upto = F.col("__tm_upto")
    prev_before = F.col("__tm_before") if lookback == "running" else prev_upto
    flag = (
        F.when(r1.isNotNull(), r1)
        .when(F.col("RN") == 1, F.lit(1))
        .when(F.coalesce(prev_upto, F.col("eDateToUse")).isNull(), F.lit(None))
        .when(eff <= F.coalesce(prev_before, esc, F.col("eDateToUse")), F.lit(1))
        .otherwise(F.lit(0))
    )
    flagged = kept.select("*", flag.alias("__tm_valid0")).drop("__tm_upto", "__tm_before")
    invalid = F.when(F.col("__tm_valid0") == 0, F.lit(True))
    inv_op = LastNonNullBefore(invalid) if lookback == "running" else Lag(invalid, 1)
    flagged = sw.add(flagged, __tm_inv=inv_op)
    valid = F.when(F.col("__tm_inv").isNotNull(), F.lit(0)).otherwise(F.col("__tm_valid0"))
    return flagged.select(
        *[c for c in flagged.columns if c not in ("__tm_valid0", "__tm_inv")], valid.alias(n.valid))


def pick_profile(df: DataFrame, keys: list[str], n: _Names, state_profile: str,
                 method: str = "window") -> DataFrame:
    """F8: one row per record - flag DESC (NULLs last), date DESC, id DESC."""
    drop = {"RN", "eDateToUse", n.r1, n.pid, CHUNK, TIE}
    cols = [c for c in df.columns if c not in drop]
    if method == "window":
        w = Window.partitionBy(*[col(k) for k in keys]).orderBy(
            col(n.valid).desc_nulls_last(), col(n.eff).desc_nulls_last(),
            col(n.pid).desc_nulls_last(), col(n.id).desc_nulls_last())
        return (
            df.select(*[col(c) for c in cols], col(n.id).alias(state_profile),
                      F.row_number().over(w).alias("__rk"))
            .where(F.col("__rk") == 1)
            .drop("__rk")
        )
    rank = F.struct(
        F.coalesce(col(n.valid), F.lit(-1)).alias("v"),
        col(n.eff).alias("e"), col(n.pid).alias("p"), col(n.id).alias("i"),
    )
    rest = [c for c in cols if c not in keys]
    best = df.groupBy(*[col(k) for k in keys]).agg(
        F.max_by(F.struct(*[col(c) for c in rest]), rank).alias("__best")
    )
    # input column order kept, then the chosen profile id
    return best.select(
        *[col(c) if c in keys else F.col("__best")[c].alias(c) for c in cols],
        F.col("__best")[n.id].alias(state_profile),
    )


def _derive(fn: Callable, df: DataFrame, prefix: str, *names: str) -> DataFrame:
    """Apply a date-deriving helper: ``fn(df)``, or the longer form
    ``fn(profiles_prefix, df, escheat_field[, due_field])``."""
    try:
        arity = len(inspect.signature(fn).parameters)
    except (TypeError, ValueError):
        arity = 1
    return df.transform(fn) if arity <= 1 else fn(prefix, df, *names)


def set_state_profile(
    prefix: str,
    df: DataFrame,
    unique_fields: list[str],
    state_profile: str,
    escheat_date_field_name: str,
    escheat_due_date_field_name: str,
    state_profiles_prefix: str,
    set_escheat_date: Callable[[DataFrame], DataFrame] | None = None,
    get_escheat_due_date: Callable[[DataFrame], DataFrame] | None = None,
    lookback: str = "running",
    pick: str = "window",
    policy: SplitPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Pick the applicable state profile per record.

    ``set_escheat_date`` / ``get_escheat_due_date`` derive the escheat date
    and its due date (``escheat_date_field_name`` /
    ``escheat_due_date_field_name``): either ``DataFrame -> DataFrame`` or
    ``(state_profiles_prefix, df, escheat_date_field_name[,
    escheat_due_date_field_name]) -> DataFrame``; pass None when the columns
    exist.
    Output: the input columns except ``{P}ProfileId``, the derived dates,
    ``{prefix}_ValidProfile`` and ``state_profile`` (= ``{P}ID``).
    """
    if lookback not in LOOKBACKS:
        raise ValueError(f"lookback must be one of {LOOKBACKS}")
    if set_escheat_date is not None:
        df = _derive(set_escheat_date, df, state_profiles_prefix, escheat_date_field_name)
    if get_escheat_due_date is not None:
        df = _derive(get_escheat_due_date, df, state_profiles_prefix, escheat_date_field_name,
                     escheat_due_date_field_name)
    for needed in (escheat_date_field_name,):
        if needed not in df.columns:
            raise ValueError(f"column {needed!r} missing; pass set_escheat_date")
    names = _Names(prefix, state_profiles_prefix, escheat_date_field_name)
    keys = list(unique_fields)
    sw = SplitWindow(df, keys, _order(names), policy)
    r1 = profile_round1(sw.prepare(df), sw, names, lookback)
    r2 = profile_round2(r1, sw, names, lookback)
    return pick_profile(r2, keys, names, state_profile, pick)


def profile_stages(prefix: str, df: DataFrame, unique_fields: list[str],
                   escheat_date_field_name: str, state_profiles_prefix: str,
                   lookback: str = "running",
                   policy: SplitPolicy | None = DEFAULT_POLICY) -> tuple[DataFrame, DataFrame]:
    """The round-1 and round-2 frames (for inspection and tests)."""
    names = _Names(prefix, state_profiles_prefix, escheat_date_field_name)
    sw = SplitWindow(df, list(unique_fields), _order(names), policy)
    r1 = profile_round1(sw.prepare(df), sw, names, lookback)
    r2 = profile_round2(r1, sw, names, lookback)
    return sw.finish(r1), sw.finish(r2)
