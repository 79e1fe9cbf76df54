import hashlib
import re

from pyspark.sql import functions as F

from layerspark.llm import pii

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


TRICKY = [
    "a@b.c.@d.ef x@y x@y.z.@q.r",
    "1.2.3.4.5.6.7.8 999.1.1.1 000255.0.0.1",
    "é" * 5 + " +1 (017) 555-7713 4111 1111 1111 1111-+49-30-1234567 a",
    "4111-1111-1111-1111 4111111111111112 0000 0000 0000",
    "+1 +12345678 +1234567890123456 (+49)30-1234567",
    "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and commit",
    "9" * 5000 + "." + "1.2" * 300,
    "x" * 5000 + "@" + "a.b" * 500,
]


def test_base_spans_against_brute_force(spark, docs, odd_docs):
    tricky = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text")).unionByName(tricky)
    texts = sorted((r.doc_id or 0, ",".join(brute(r.text))) for r in table.collect())
    got = pii.find(table).collect()
    assert sorted(
        (i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts
    ) == sorted((r.doc_id or 0, r.base_sha256) for r in got)
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append(t)
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        base = [s for s in spans if s.split(":")[0] in KINDS]
        assert ",".join(base) in want[r.doc_id or 0]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in KINDS]


def test_method_finds_secrets_and_spares_prose(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find(docs).collect():
        added = [s.split(":") for s in r.spans.split(",") if s and s.split(":")[0] not in KINDS]
        secrets = {m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', texts[r.doc_id])}
        assert {(int(a), int(b)) for k, a, b in added if k == "secret"} == secrets
        assert all(k == "secret" for k, _, _ in added)


def test_reliabilities_recover_labelers():
    """Votes drawn from known reliabilities are estimated back."""
    import numpy as np

    rng, rows = np.random.default_rng(0), {}
    rates = {"v_shape": (0.9, 0.2), "v_check": (0.8, 0.1), "v_gazetteer": (0.7, 0.05), "v_telling": (0.85, 0.3)}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple(int(rng.random() < a[0 if truth else 1]) for a in rates.values())
        rows[votes] = rows.get(votes, 0) + 1
    table = [
        dict(zip(rates, v)) | {"v_misleading": -1, "v_edge": -1, "kind": "email", "n": n} for v, n in rows.items()
    ]
    found, _ = pii.reliabilities(table, rounds=300)
    for name, (hit, false) in rates.items():
        assert abs(found[name][0] - hit) < 0.08 and abs(found[name][1] - false) < 0.08


def test_masked_text(spark, clashing, no_docs):
    clean = pii.redact(clashing, length="n_chars")
    assert clean.columns == clashing.columns and clean.count() == clashing.count()
    row = clean.filter("doc_id = 7").first()
    assert row.text.startswith("[EMAIL] [IP] +49 30") and row.text.endswith(" <|endoftext|> é")
    assert row.n_chars == len(row.text)
    assert clean.filter("doc_id = 1").first().text is None
    assert pii.redact(no_docs, length="n_chars").count() == 0
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(k).alias("kind"), F.lit(b).alias("end")) for a, k, b in
                      [(1, "x", 4), (2, "y", 6), (8, "z", 9)]])
    assert spark.range(1).select(pii.masked(F.lit("0123456789"), spans).alias("t")).first().t == "0[X]67[Z]9"


def test_no_python_on_the_executors(docs):
    plan = pii.find(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
