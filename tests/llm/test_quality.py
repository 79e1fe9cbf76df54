import re

from compare import difference
from pyspark.sql import functions as F

from layerspark.llm import oracles, quality, queries


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, again = set(), set()
    for g in grams:
        (again if g in seen else seen).add(g)
    covered = {i + k for i, g in enumerate(grams) if g in again for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return *counts, len(words) < 10 or 100 * len(covered) > 20 * len(words)


def test_against_sql(spark, sf):
    name = "op5_quality_rules"
    assert difference(spark, sf, queries.registry()[name], oracles.registry()[name]) is None


def test_against_brute_force(docs, odd_docs):
    for table in (docs, odd_docs):
        texts = sorted(((r.doc_id is None, r.doc_id or 0, *brute(r.text)) for r in table.collect()))
        got = quality.judge(table).collect()
        assert texts == sorted((r.doc_id is None, r.doc_id or 0, *r[1:7]) for r in got)


def test_kept_needs_base_and_rules(docs):
    for r in quality.judge(docs).collect():
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_rules_are_a_table(odd_docs):
    strict = (quality.Rule("tiny", "n_words", None, 5.0),)
    failed = {r.doc_id: r.failed_rules for r in quality.judge(odd_docs.filter("doc_id < 6"), rules=strict).collect()}
    assert failed[5] == "tiny" and failed[2] == ""


def test_keep_good_keeps_rows_whole(docs, clashing, no_docs):
    kept = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept
    assert quality.keep_good(clashing).columns == clashing.columns
    assert quality.keep_good(clashing).count() == quality.judge(clashing).filter("kept").count() == 4
    assert quality.judge(no_docs).count() == 0


def test_labelled_clean_documents_stay(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.judge(docs).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert judged.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.99


def test_one_projection_without_python(docs):
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
