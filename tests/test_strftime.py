import pytest

from tidemark.functions.strftime import bad_format, to_regex


@pytest.mark.parametrize("fmt", ["%Y-%m-%d", "%H:%M:%S.%f", "%a %d %b %Y", "%Y-%m-%d %z", "plain", "100%%"])
def test_common_patterns_stay_on_the_jvm(fmt):
    assert to_regex(fmt) is not None


@pytest.mark.parametrize("fmt", ["%c", "%x %X", "%G-%V-%u", "%Z", "%Y %U %w", "%Y %W %A"])
def test_locale_and_week_patterns_stay_on_the_jvm(spark, fmt):
    from pyspark.sql import functions as F

    from tidemark.functions.strftime import parses_with

    assert to_regex(fmt) is not None
    plan = spark.range(1).select(parses_with(F.lit("x").cast("string"), fmt))._jdf.queryExecution().toString()
    assert "Python" not in plan


@pytest.mark.parametrize("fmt,bad", [("%Q", True), ("%Y-%", True), ("%Y-%m-%d", False), ("plain", False)])
def test_bad_patterns_are_known(fmt, bad):
    assert (bad_format(fmt) is not None) == bad


CASES = {
    "%Y-%m-%d": ["2024-01-05", "2024-1-5", "2024-13-01", "2023-02-29", "2024-02-29", "24-01-05",
                 "2024-01-05 ", " 2024-01-05", "2024/01/05"],
    "%d/%m/%Y": ["05/01/2024", "5/1/2024", "32/01/2024"],
    "%H:%M:%S": ["23:59:59", "24:00:00", "7:5:3", "12:60:00", "12:30", "12:30:01.5", "12:30:60", "12:30:61", "12:06:1", "10:60:60"],
    "%H:%M:%S.%f": ["12:30:01.5", "12:30:01.123456", "12:30:01.1234567", "12:30:01"],
    "%Y%m%d": ["20240105", "202401055", "2024015", "2024111", "20241131"],
    "%Y": ["0000", "0001", "9999", "12345", "\u00012024", "\u00012024\u0001"],
    "%d %m": ["29 02", "29  2", "30 4", "31 4"],
    "%y-%m-%d": ["00-02-29", "68-1-1", "69-1-1", "99-02-29"],
    "%a %d %b %Y": ["Mon 01 Jan 2024", "mon 1 jan 2024", "Xyz 01 Jan 2024", "Mon  1 Jan 2024"],
    "%A, %d %B %Y": ["Monday, 1 May 2024", "monday, 31 june 2024"],
    "%Y-%m-%d %z": ["2024-01-05 +0100", "2024-01-05 +01:30", "2024-01-05 Z", "2024-01-05 UTC"],
    "%Y  %m": ["2024 1", "2024   12", "2024"],
    "a.b %Y": ["a.b 2024", "axb 2024", "A.B 2024"],
    "%d/%m": ["29/02", "28/02"],
    "%d %b %Y": ["05 Jan 2024", "05 jan 2024", "05 January 2024", "5 Jan 2024"],
    "%d %B %Y": ["05 January 2024", "05 Jan 2024", "05 january 2024"],
    "%I:%M %p": ["07:30 PM", "7:30 pm", "13:30 PM", "00:30 AM"],
    "%j/%Y": ["032/2024", "32/2024", "366/2024"],
    "%G-%V-%u": ["2020-53-1", "2021-53-1", "2024-01-7", "2024-00-1", "2024-1-8", "0000-01-1", "0001-01-1", "9999-52-5", "9999-52-6", "1976-53-4", "2004-53-1", "1-1-1"],
    "%G-W%V": ["2024-W01"], "%V %u": ["10 3"], "%Y-%V-%u": ["2024-10-3"], "%G-%j": ["2024-100"], "%Y %G %V %a": ["2024 2020 53 mon", "0000 2020 53 mon", "2024 2021 53 mon"],
    "%Y %U %w": ["2024 00 0", "2024 53 6", "2024 54 1", "0001 0 0", "0001 0 1", "0001 0 6", "9999 52 5", "9999 52 6", "9999 53 0", "0000 10 1", "2024 1 7"],
    "%Y %W %A": ["2024 0 Sunday", "2024 53 monday", "0001 00 Monday", "0001 0 Sunday", "9999 52 Friday", "9999 52 Saturday", "2024 5 Mon"],
    "%Y %U": ["2024 53", "0000 1", "2024 60"], "%U %a": ["53 Mon", "0 sun"], "%y-%W-%u": ["00-00-1", "69-53-7", "99-1-0"],
    "%Y-%j %d": ["2023-366 31", "9999-366 01", "0000-001 01", "2024-366 31"],
    "%c": ["Mon Jan  1 10:00:00 2024", "Mon Jan 01 10:00:00 2024", "Tue Feb 30 10:00:00 2024", "2024"],
    "%x": ["02/29/24", "02/29/23", "2/9/23", "13/01/23"], "%X": ["23:59:60", "24:00:00"], "%x %X": ["01/02/24 10:00:00"],
    "%H:%M %Z": ["10:00 UTC", "10:00 gmt", "10:00 CEST", "10:00 "],
    "%Y\u0001%m": ["2024\u000112", "2024\u000113", "202412"], "%m %b": ["13 Feb", "3 Feb"],
    "%Y-%m-%dT%H:%M:%S": ["2024-01-05T10:00:60", "2024-01-05T10:00:00", "2024-01-05 10:00:00"],
}


def test_agrees_with_strptime(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.functions.strftime import parses_with

    rows = [(f, v) for f, vs in CASES.items() for v in vs]
    df = spark.createDataFrame(rows, "fmt string, v string")
    for fmt in CASES:
        for r in df.where(F.col("fmt") == fmt).select("v", parses_with(F.col("v"), fmt).alias("ok")).collect():
            try:
                dt.datetime.strptime(r["v"], fmt)
                want = True
            except ValueError:
                want = False
            assert r["ok"] == want, (fmt, r["v"])


def test_random_texts_agree_with_strptime(spark):
    """Texts put together from each directive's own alternatives and near misses."""
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from tidemark.functions.strftime import parses_with

    rnd = random.Random(21)
    day = lambda: dt.date.fromordinal(rnd.choice([rnd.randint(1, 3652059), rnd.randint(730000, 740000), rnd.randint(1, 8), rnd.randint(3652050, 3652059)]))
    formats = ["%Y-%m-%d", "%G %V %u", "%Y/%U/%w", "%Y/%W/%u", "%Y %W %a", "%Y %U %A", "%j.%Y", "%d %b %Y", "%c", "%x", "%G %V %a"]
    for fmt in formats:
        texts = []
        for _ in range(120):
            t = day().strftime(fmt)
            t = " ".join(x.zfill(4) if x.isdigit() and fmt.endswith("%Y") and len(x) < 4 and x == t.split()[-1] else x for x in t.split(" "))
            if rnd.random() < 0.5:
                k = rnd.randrange(len(t))
                t = t[:k] + rnd.choice("0123456789 ") + t[k + rnd.randint(0, 1):]
            texts.append(t)
        df = spark.createDataFrame([(t,) for t in texts], "v string")
        for r in df.select("v", parses_with(F.col("v"), fmt).alias("ok")).collect():
            try:
                dt.datetime.strptime(r["v"], fmt)
                want = True
            except ValueError:
                want = False
            assert r["ok"] == want, (fmt, r["v"])
