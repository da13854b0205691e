import tempfile

from tidemark.streaming import quality_batch_writer


def test_micro_batch_writer_appends_report(spark):
    out = tempfile.mkdtemp(prefix="tm-report-") + "/report"
    write = quality_batch_writer(
        1, "crm", "users", out,
        rules=[{"field_name": "name", "expectation": "required", "expectation_action": "warn"}])
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, name string")
    write(df, 7)
    write(df.where("id = 1"), 8)
    write(df, 7)  # a re-run epoch replaces its own report
    got = sorted((str(r["batch_id"]), r["success"], r["unexpected_count"])
                 for r in spark.read.parquet(out).collect())
    assert got == [("7", False, 2), ("8", True, 0)]
