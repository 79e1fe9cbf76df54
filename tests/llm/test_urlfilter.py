import math

from pyspark.sql import functions as F

from layerspark.llm import urlfilter

CASES = [
    ("http://A.Example.NET/en/1?x=/de/", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://x.net/q#f", "x.net", "/q", "net/", "block"),
    ("https://x.net", "x.net", "", None, None),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("https://w.org/fr/a", "w.org", "/fr/a", "org/fr/", "allow"),
    ("ftp://casino-win.example.com?x", "casino-win.example.com", "", None, "block"),
    ("http://CheapPills.example.com/x", "cheappills.example.com", "/x", None, "block"),
    ("http://É.example.com/a://b", "É.example.com", "/a://b", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("x://" + "a" * 5000, "a" * 5000, "", None, "allow"),
]


def test_rules_and_verdicts(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = spark.createDataFrame([(-1 - i, c[0], None) for i, c in enumerate(CASES)], pages.schema)
    got = {r.page_id: r for r in urlfilter.judge(pages.unionByName(odd)).collect()}
    assert len(got) == pages.count() + len(CASES)
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = got[-1 - i]
        assert (r.host, r.path, r.rule) == (host, path, rule), CASES[i]
        assert verdict is None or r.verdict == verdict, CASES[i]


def test_known_hosts(spark, sf):
    judged = urlfilter.judge(spark.read.parquet(f"{sf}/pages.parquet")).filter("rule is null")
    bad = judged.filter(F.col("host").rlike("casino|bets|pills|ads-track"))
    assert bad.filter("verdict = 'allow'").count() == 0
    assert judged.filter("verdict = 'block'").count() == bad.count()


def best_cut(model, label):
    """Cheapest of all ways to cut a label."""
    cost = lambda w: model.cost.get(w, model.unknown + 2.3 * len(w))
    ways = [[label]]
    for bits in range(1 << (len(label) - 1)):
        cut, word = [], label[0]
        for i, c in enumerate(label[1:]):
            if bits >> i & 1:
                cut.append(word)
                word = ""
            word += c
        ways.append([*cut, word])
    return min(sum(map(cost, w)) for w in ways)


def test_viterbi_finds_the_best_cut():
    model = urlfilter.Segmenter({"cheap": 50, "pills": 20, "pill": 30, "she": 90, "a": 400, "he": 80, "ap": 2})
    for label in ("cheappills", "ashehe", "xqzt", "a", "pillsheap"):
        words = model.words(label)
        assert "".join(words) == label
        cost = sum(model.cost.get(w, model.unknown + 2.3 * len(w)) for w in words)
        assert math.isclose(cost, best_cut(model, label))
    assert model.words("cheappills") == ["cheap", "pills"]


def test_repeats_nulls_and_empty(spark):
    schema = "page_id long, url string, html string, host string, words int"
    rows = [(1, "http://a.com/b", None, "clash", 1)] * 2 + [(None, "http://a.com/b", "", None, None)]
    got = urlfilter.judge(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [(0, "a.com", "allow"), (1, "a.com", "allow"), (1, "a.com", "allow")]
    assert urlfilter.judge(spark.createDataFrame([], schema)).count() == 0
