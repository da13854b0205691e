"""Seeded random data vs brute-force Python for the window functions and the
profile selection, with and without hot-key splitting."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.profiles import set_state_profile
from tidemark.operators.split_window import (
    FirstNonNull, Lag, LastNonNullBefore, LastNonNullUpTo, Lead, LaterNonNull, RowNumber,
    SplitPolicy, SplitWindow,
)

SPLIT = SplitPolicy(hot_rows=3, chunk_rows=2)


# ---------------------------------------------------------------- windows

def _window_rows(seed):
    rnd = random.Random(seed)
    rows = []
    i = 0
    for g in range(12):
        for _ in range(rnd.randint(1, 30)):
            v = None if rnd.random() < 0.35 else round(rnd.uniform(0, 9), 2)
            t = None if rnd.random() < 0.1 else rnd.randint(0, 6)
            rows.append((g, t, i, v, rnd.randint(0, 1)))
            i += 1
    return rows


def _sort_key(descending):
    if descending:  # t DESC NULLS LAST, then i
        return lambda r: (r[1] is None, -(r[1] or 0), r[2])
    return lambda r: (r[1] is not None, r[1] or 0, r[2])  # t ASC NULLS FIRST, then i


def _brute_windows(rows, descending=False):
    out = {}
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for g, rs in groups.items():
        rs.sort(key=_sort_key(descending))
        vals = [r[3] for r in rs]
        for k, r in enumerate(rs):
            nn_upto = [v for v in vals[:k + 1] if v is not None]
            nn_before = [v for v in vals[:k] if v is not None]
            later = [rs[j][2] for j in range(k + 1, len(rs)) if rs[j][4] == 1]
            out[r[2]] = (
                k + 1,
                nn_upto[0] if nn_upto else None,
                nn_upto[-1] if nn_upto else None,
                nn_before[-1] if nn_before else None,
                vals[k - 1] if k >= 1 else None,
                vals[k - 2] if k >= 2 else None,
                vals[k + 1] if k + 1 < len(rs) else None,
                rs[k + 2][4] if k + 2 < len(rs) else None,
                later[-1] if later else None,
            )
    return out


@pytest.mark.parametrize("seed,descending", [(1, False), (2, True), (3, False), (4, True)])
@pytest.mark.parametrize("policy", [None, SPLIT])
def test_windows_match_brute_force(spark, seed, descending, policy):
    rows = _window_rows(seed)
    df = spark.createDataFrame(rows, "g int, t int, i int, v double, f int")
    ops = dict(
        rn=RowNumber(), first=FirstNonNull(F.col("v")), upto=LastNonNullUpTo(F.col("v")),
        before=LastNonNullBefore(F.col("v")), lag1=Lag(F.col("v")), lag2=Lag(F.col("v"), 2),
        lead1=Lead(F.col("v")), lead2=Lead(F.col("f"), 2),
        later=LaterNonNull(F.when(F.col("f") == 1, F.col("i"))),
    )
    order = [("t", "desc"), "i"] if descending else ["t", "i"]
    sw = SplitWindow(df, ["g"], order, policy)
    assert sw.split == (policy is not None)
    got = {r["i"]: tuple(r[k] for k in ops)
           for r in sw.finish(sw.add(sw.prepare(df), **ops)).collect()}
    assert got == _brute_windows(rows, descending)


# ---------------------------------------------------------------- profiles

D0 = dt.date(2020, 1, 1)


def _d(rnd, p_null=0.0, span=60):
    return None if rnd.random() < p_null else D0 + dt.timedelta(days=rnd.randint(0, span))


def _profile_rows(seed):
    rnd = random.Random(seed)
    rows = []
    ident = 0
    for key in range(80):
        sold = _d(rnd, 0.3)
        repl = _d(rnd, 0.6)
        for pos in range(1, rnd.randint(1, 10) + 1):
            ident += 1
            rows.append((key, _d(rnd, 0.05), pos, "SOLDONORAFTER" if rnd.random() < 0.4 else "OTHER",
                         ident, _d(rnd, 0.3, 90), sold, repl))
    return rows


def _le(a, b):
    return a is not None and b is not None and a <= b


def _brute_profiles(rows, lookback):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    winners = {}
    for key, rs in groups.items():
        # order: effective date (NULL first), profile id, id
        rs.sort(key=lambda r: (r[1] is not None, r[1] or D0, r[2], r[4]))
        esc = [r[5] for r in rs]
        n = len(rs)
        edate = []
        for k in range(n):
            nn = [e for e in esc[:k + 1] if e is not None]
            edate.append(nn[0] if nn else None)
        raw = []
        for r in rs:
            if r[3] != "SOLDONORAFTER":
                raw.append(None)
            else:
                raw.append(1 if (_le(r[1], r[6]) or _le(r[1], r[7])) else 0)
        r1 = []
        for k in range(n):
            if lookback == "running":
                demote = any(raw[j] == 1 for j in range(k + 1, n))
            else:
                demote = k + 1 < n and raw[k + 1] == 1
            r1.append(0 if demote else raw[k])
        kept1 = [k for k in range(n) if r1[k] in (None, 1)]
        rn = {k: i + 1 for i, k in enumerate(kept1)}
        kept2 = [k for k in kept1
                 if r1[k] == 1 or rn[k] == 1 or esc[k] is None or _le(rs[k][1], esc[k])]
        vp0 = []
        for idx, k in enumerate(kept2):
            if lookback == "running":
                upto = [esc[j] for j in kept2[:idx + 1] if esc[j] is not None]
                before = [esc[j] for j in kept2[:idx] if esc[j] is not None]
                prev_upto = upto[-1] if upto else None
                prev_before = before[-1] if before else None
            else:
                prev_upto = prev_before = esc[kept2[idx - 1]] if idx > 0 else None
            first = lambda *xs: next((x for x in xs if x is not None), None)
            if r1[k] is not None:
                v = r1[k]
            elif rn[k] == 1:
                v = 1
            elif first(prev_upto, edate[k]) is None:
                v = None
            elif _le(rs[k][1], first(prev_before, esc[k], edate[k])):
                v = 1
            else:
                v = 0
            vp0.append(v)
        vp = []
        for idx in range(len(kept2)):
            if lookback == "running":
                inv = any(vp0[j] == 0 for j in range(idx))
            else:
                inv = idx > 0 and vp0[idx - 1] == 0
            vp.append(0 if inv else vp0[idx])
        if not kept2:
            continue

        def rank(idx):
            k = kept2[idx]
            r = rs[k]
            return (-1 if vp[idx] is None else vp[idx], r[1] is not None, r[1] or D0, r[2], r[4])

        best = max(range(len(kept2)), key=rank)
        winners[key] = (rs[kept2[best]][4], vp[best])
    return winners


@pytest.mark.parametrize("lookback", ["running", "adjacent"])
@pytest.mark.parametrize("policy", [None, SPLIT])
def test_profiles_match_brute_force(spark, lookback, policy):
    rows = _profile_rows(7)
    schema = ("Key int, SP_EffectiveDate date, SP_ProfileId int, SP_EffectiveDateType string, "
              "SP_ID int, EscheatDate date, SoldDate date, ReplacementDate date")
    df = spark.createDataFrame(rows, schema)
    out = set_state_profile(
        prefix="P", df=df, unique_fields=["Key"], state_profile="Best",
        escheat_date_field_name="EscheatDate", escheat_due_date_field_name="EscheatDueDate",
        state_profiles_prefix="SP_", lookback=lookback, policy=policy,
    )
    got = {r["Key"]: (r["Best"], r["P_ValidProfile"]) for r in out.collect()}
    assert got == _brute_profiles(rows, lookback)
