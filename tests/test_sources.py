import tempfile

from pyspark.sql import types as T

from tidemark.operators.validate import quality_report
from tidemark.plans.rules import compile_rules
from tidemark.sources.tables import infer_types, parse_csv_lines, read_csv, read_csv_checked, typed


def test_csv_with_header_and_between_rule(spark):
    path = tempfile.mkdtemp(prefix="tm-csv-") + "/trips.csv"
    with open(path, "w") as fh:
        fh.write("vendor_id,passenger_count,fare\n")
        for i, pc in enumerate([1, 2, 3, 6, 7, None, 4, 0]):
            fh.write(f"{i},{'' if pc is None else pc},{i * 1.5}\n")
    df = read_csv(spark, path)
    assert isinstance(df.schema["passenger_count"].dataType, T.IntegerType)
    suite = compile_rules(spark, [{"field_name": "passenger_count",
                                   "expectation": "number_range(2, 6)",
                                   "expectation_action": "warn"}], df.schema)
    r = quality_report(df, suite).collect()[0]
    assert (r["success"], r["missing_count"], r["unexpected_count"]) == (False, 1, 3)


def test_rejected_lines_are_told_apart(spark, tmp_path):
    lines = ["id,name,when,n,empty", "1,Ann,2024-01-05,007,", '2,"Bo, B",2024-02-06,8,', "3,too,few", "4,one,2024-01-01,2,,more", '5,,,,', "3000000000,C,2024-03-07,9,"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    rows, rejected = read_csv_checked(spark, str(tmp_path / "t.csv"))
    assert rows.schema.simpleString() == "struct<id:bigint,name:string,when:date,n:string,empty:string>"
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 5, 3000000000]
    assert {r["n"] for r in rows.collect()} == {"007", "8", None, "9"}
    assert sorted(r["line"] for r in rejected.collect()) == ["3,too,few", "4,one,2024-01-01,2,,more"]


def test_types_fit_all_values(spark):
    cases = {"boolean": ["true", "FALSE", None], "int": ["1", "-7", "+3"], "bigint": ["1", "3000000000"], "double": ["1", "2.5", "1e3", "NaN"],
             "date": ["2024-02-29", None], "timestamp": ["2024-02-29 10:00:00", "2024-02-29T10:00"], "string": ["2024-02-30", "2024-01-01"]}
    texts = {**cases, "string2": ["9" * 30, "x"], "string3": [None, None], "double2": ["9" * 30, "1"], "string4": [" 1", "1"], "date2": ["2024-01-01", "2024-12-31"]}
    width = max(map(len, texts.values()))
    rows = [tuple((v + [None] * width)[k] for v in texts.values()) for k in range(width)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in texts))
    got = {f.name: f.dataType.simpleString() for f in infer_types(df).fields}
    assert got == {n: n.rstrip("234") for n in texts}
    assert typed(df, infer_types(df)).select("int").collect()[1][0] == -7


def test_lines_keep_other_columns_and_quotes(spark):
    df = spark.createDataFrame([(1, 'a,"x, y"'), (2, "a"), (3, None), (4, "a,b,c")], "row int, value string")
    got = {r["row"]: (r["p"], r["q"], r["_rejected"]) for r in parse_csv_lines(df, ["p", "q"]).collect()}
    assert got == {1: ("a", "x, y", None), 2: (None, None, "a"), 3: (None, None, None), 4: (None, None, "a,b,c")}
