from compare import difference
from pyspark.sql import functions as F

from layerspark.llm import mixing, oracles, queries


def test_against_sql(spark, sf):
    name = "op2_mix_sources"
    assert difference(spark, sf, queries.registry()[name], oracles.registry()[name]) is None


def leaves(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, tokens long, docs long")


def targets(spark, rows, **kw):
    mixture = mixing.Mixture(**{"epochs": 1, **kw})
    return {(r.domain, r.lang, r.source): r.target for r in mixing.leaf_budgets(leaves(spark, rows), mixture).collect()}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("a", "en", "s1", 10, 1), ("a", "en", "s2", 500, 1), ("b", "en", "s3", 490, 1)]
    # Half of 1000 tokens to each domain's 250: s1 gives 10, its sibling s2 takes the other 240.
    got = targets(spark, rows, budget_percent=50)
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 240, ("b", "en", "s3"): 250}
    # When the whole domain is short, the rest goes one level up.
    rows = [("a", "en", "s1", 10, 1), ("a", "en", "s2", 20, 1), ("b", "en", "s3", 970, 1)]
    got = targets(spark, rows, budget_percent=50)
    assert got == {("a", "en", "s1"): 10, ("a", "en", "s2"): 20, ("b", "en", "s3"): 470}


def test_weights_and_epochs(spark):
    rows = [("a", "en", "s1", 100, 1), ("a", "de", "s1", 100, 1), ("a", "fr", "s1", 100, 1)]
    got = targets(spark, rows, languages={"en": 3, "de": 1, "fr": 0}, epochs=2)
    assert got == {("a", "en", "s1"): 200, ("a", "de", "s1"): 100, ("a", "fr", "s1"): 0}


def test_hot_source_in_slices_is_the_same(docs, monkeypatch):
    want = sorted(map(tuple, mixing.draw(docs).collect()))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 3)
    assert sorted(map(tuple, mixing.draw(docs).collect())) == want


def test_exact_tokens_per_leaf(docs):
    drawn = mixing.draw(docs)
    total = docs.select(F.sum(F.size(F.split(F.btrim("text", F.lit(" \n\t")), r"\s+")))).first()[0]
    assert abs(drawn.agg(F.sum("taken")).first()[0] - total) < 200
    cut = drawn.filter("taken < tokens").groupBy("domain", "lang", "source").count()
    assert cut.filter("count > 1").count() == 0


def test_mixed_documents(spark, clashing, no_docs):
    out = mixing.mixed(clashing, length="n_chars")
    assert out.columns == clashing.columns
    for r in out.collect():
        assert r.text and r.text.strip()
    assert mixing.mixed(no_docs, length="n_chars").count() == 0
    text = spark.createDataFrame([("  a b\t\tc  d ", 3), ("a b", 5), ("a", 1)], "t string, n int")
    got = [r[0] for r in text.select(mixing.token_prefix(F.col("t"), F.col("n"))).collect()]
    assert got == ["a b\t\tc", "a b", "a"]


def test_no_python_on_the_executors(docs):
    plan = mixing.draw(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
