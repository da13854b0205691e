"""Registered queries against DuckDB where SQL expresses them, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tidemark.llm import decontaminate, near_dup, quality_classifier, substring_dedup
from tidemark.llm.common import crc_mod
from tidemark.llm.oracle import LLM_ORACLE_SQL
from tidemark.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    assert {k.split("_")[0] for k in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in E.queries() and set(LLM_ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(LLM_ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    want = sorted(str(dict(sorted(zip(names, r, strict=True)))) for r in cur.fetchall())
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in df.collect()) == want


def test_pipeline_is_its_operators_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    frame = lambda: spark.createDataFrame(list(left.items()), "doc_id long, text string")
    scores = quality_classifier.score_quality(frame(), labels, crc_mod(F.col("doc_id"), 5) != 0).collect()
    left = {r["doc_id"]: left[r["doc_id"]] for r in scores if r["predicted"]}
    left = {r["doc_id"]: left[r["doc_id"]] for r in near_dup.near_duplicates(frame(), percent=80).collect() if r["kept"]}
    cut = substring_dedup.remove_repeats(frame()).collect()
    left = {r["doc_id"]: r["kept_text"] if r["n_removed"] else left[r["doc_id"]] for r in cut}
    left = {r["doc_id"]: left[r["doc_id"]] for r in decontaminate.find_contamination(frame(), bench).collect() if not r["contaminated"]}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(left) and 0 < len(got) < docs.count()
    import hashlib
    assert all(r["decoded_sha256"] == hashlib.sha256((left[r["doc_id"]] or "").encode()).hexdigest() for r in got)


def test_stages_but_the_last_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString(), name
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_the_stage_links_near_copies_from_four_fifths_on(spark):
    """Five-word Jaccard of 0.80 to 0.85, and just below 0.8."""
    words = [f"w{k}" for k in range(104)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-10] + [f"x{k}" for k in range(10)])), (3, " ".join(f"y{k}" for k in range(104))),
            (4, " ".join([f"y{k}" for k in range(92)] + [f"z{k}" for k in range(12)]))]
    sets = {i: {tuple(t.split()[s:s + 5]) for s in range(100)} for i, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.80 <= alike(1, 2) < 0.85 and alike(3, 4) < 0.80
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_rows_without_an_id_are_not_held_out(spark, tmp_path):
    """Registered queries over tables with null ids, null texts and repeated rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    docs.unionByName(more).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    for name in ("op6_lm_scoring", "op7_toxicity_lexicon", "op9_quality_classifier"):
        rows = E.queries()[name](spark, str(tmp_path)).collect()
        assert len(rows) == docs.count() + 6 and not any(r["held_out"] is None for r in rows), name
        assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False] * 3


def test_held_out_labels_are_met(spark):
    """Accuracy on labels that the models never saw, of all labelled documents."""
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, label in (("op7_toxicity_lexicon", "toxic"), ("op9_quality_classifier", "quality")):
        rows = E.queries()[name](spark, sf).join(labels, "doc_id").where("held_out").select("predicted", label).collect()
        right = sum(r["predicted"] == r[label] for r in rows)
        assert len(rows) > 50 and right >= 0.95 * len(rows), (name, right, len(rows))
