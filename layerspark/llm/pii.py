"""Personal data by weak supervision, in built-in expressions only.

Fixed patterns find the base spans (email, ip, card, phone); they always stay. One
wider pattern proposes more candidates (secret, name, iban, ip6, hidden email,
local phone). Labelers of three sorts vote on every candidate: regex and checksum,
gazetteer, and context. Expectation-maximisation over the counts of vote patterns
estimates each labeler's reliability without labels, and a logistic span classifier
learns from the resulting soft labels on shape and context features, so it does not
need the votes. It decides which proposed candidates are added.

Counts of vote and feature patterns are taken over all documents. Their table is
bounded by the number of patterns, not by the input, and is all that the driver sees.

Defined results: a null text counts as empty and has no spans; its base digest is
that of the empty string. Positions are code points, ends exclusive. Repeated rows
are searched one by one; a null key stays null; columns beside key and text are not
read by ``find`` and return unchanged from ``redact``. Possessive quantifiers keep
very long runs from exhausting the stack or backtracking; where a match can only
begin at the head of a run (or where the last match ended) the pattern says so,
which changes no match. With no candidates at all the classifier adds nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import computed_once, fresh_name, let, text_or_empty
from layerspark.session import materialize

HEAD = r"(?:\G|(?<![{0}]))"
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": HEAD.format(LOCAL) + rf"[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": HEAD.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

# Shapes of the further candidates; the first that fits names the kind.
FREE = "A-Za-z0-9_+/=-"
SHAPES = {
    "hidden_email": rf"(?<![{LOCAL}])[{LOCAL}]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra|Sr)\b\.?\x20\p{Lu}\p{Ll}{1,40}(?:\x20\p{Lu}\p{Ll}{1,40})?",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}\b",
    "ip6": r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "secret": rf"(?<![{FREE}])(?=[A-Za-z_+/=-]*+[0-9])[{FREE}]{{20,}}+",
}
KINDS = (*BASE, *SHAPES)

# What tends to stand before personal data, and before numbers that only look like it.
TELLING = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "hidden_email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|from|adresse|login",
    "ip6": r"\bip\b|address|host|server|from|adresse|login",
    "card": "card|visa|master|credit|karte|carte|tarjeta|pay",
    "phone": r"phone|\btel|call|mobile|fax|telefon|tél|móvil",
    "local_phone": r"phone|\btel|call|mobile|fax|telefon|tél|móvil",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "name": "dear|signed|regards|sincerely|geehrte|cher|estimad|by",
    "secret": r"token|secret|passw|pwd|api[_ -]?key|access[_ -]?key|auth|bearer|credential",
}
MISLEADING = r"version|isbn|issn|order|invoice|page|figure|section|chapter|sha1|sha256|md5|commit|uuid|[$€£#§]\s*$"
GAZETTEER = {
    "email": r"(?i)(?:gmail|yahoo|outlook|hotmail|mail[0-9]*|example)\.(?:com|org|net|de|fr|es)|\.(?:com|org|net|edu|gov|de|fr|es|io)$",
    "hidden_email": r"(?i)(?:gmail|yahoo|outlook|hotmail|example)|(?:com|org|net|edu|de|fr|es)$",
    "name": r"(?:John|Mary|James|Anna|Peter|Paul|Maria|Hans|Jean|Marie|José|Carmen|Smith|Miller|Müller|Schmidt|Martin|García)",
    "secret": r"^(?:AKIA|ASIA|gh[pousr]_|sk[-_]|xox[abp]-|eyJ|AIza|glpat-)",
    "iban": r"^(?:DE|FR|ES|GB|IT|NL|AT|CH|BE|PT|PL)",
}
LABELERS = ("v_shape", "v_check", "v_gazetteer", "v_telling", "v_misleading", "v_edge")
FEATURES = ("kind", "length", "digits", "variety", "before", "after", "telling", "misleading")
CONTEXT = 32


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: ``start, end, value`` and the text on either side.

    The gaps between matches give their places in code points.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")

    def placed(hits: Column, gaps: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            gap, value = F.get(gaps, i), F.get(hits, i)
            start = acc["at"] + F.length(gap)
            end = start + F.length(value)
            one = F.struct(
                start.alias("start"),
                end.alias("end"),
                value.alias("value"),
                F.right(gap, F.lit(CONTEXT)).alias("left"),
                F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("right"),
            )
            return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

        begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), begin, step, lambda acc: acc["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return let(
        found, lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(gaps, lambda g: placed(hits, g)))
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All valid base matches, by start and then kind."""

    def of(kind: str, pattern: str) -> Column:
        good = F.filter(matches(text, pattern), lambda m: _valid(kind, m["value"]))
        return F.transform(good, lambda m: _span(F.lit(kind), m))

    return F.sort_array(F.concat(*[of(k, p) for k, p in BASE.items()]))


def _span(kind: Column, m: Column) -> Column:
    rank = F.lit(0)
    for i, name in enumerate(KINDS):
        rank = F.when(kind == name, i).otherwise(rank)
    return F.struct(
        m["start"].alias("start"), rank.alias("rank"), kind.alias("kind"), m["end"].alias("end"),
        m["value"].alias("value"), m["left"].alias("left"), m["right"].alias("right"),
    )


def proposed_spans(text: Column, base: Column) -> Column:
    """Further candidates that overlap no base span."""

    def kind_of(value: Column) -> Column:
        kind = F.lit("secret")
        for name, shape in reversed(list(SHAPES.items())):
            kind = F.when(value.rlike(f"^(?:{shape})$"), name).otherwise(kind)
        return kind

    found = matches(text, "|".join(f"(?:{s})" for s in SHAPES.values()))
    free = F.filter(
        found, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    return F.transform(free, lambda m: _span(kind_of(m["value"]), m))


def _by_kind(kind: Column, table: dict[str, Column], other: Column) -> Column:
    out = other
    for name, value in table.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _vote(yes: Column | None = None, no: Column | None = None) -> Column:
    """1 for personal data, 0 against, -1 for no opinion."""
    out = F.lit(-1)
    if no is not None:
        out = F.when(no, 0).otherwise(out)
    return out if yes is None else F.when(yes, 1).otherwise(out)


def _facts(span: Column) -> Column:
    """Votes and features of a span as one struct."""
    kind, value = span["kind"], span["value"]
    digits = F.length(_digits(value))
    variety = F.size(F.array_distinct(F.split(F.lower(value), "")))
    telling = F.lower(span["left"]).rlike("|".join(f"(?:{p})" for p in sorted(set(TELLING.values()))))
    told = _by_kind(kind, {k: F.lower(span["left"]).rlike(p) for k, p in TELLING.items()}, F.lit(False))
    misled = F.lower(span["left"]).rlike(MISLEADING)
    before, after = F.right(span["left"], F.lit(1)), F.left(span["right"], F.lit(1))

    def edge(c: Column) -> Column:
        return F.when((c == "") | c.rlike(r"\s"), "space").when(c.rlike(r"[\p{L}\p{N}_]"), "word").otherwise("mark")

    shape = _by_kind(
        kind,
        {
            "email": _vote(value.rlike(r"\.[A-Za-z]{2,24}$"), ~value.rlike(r"\.[A-Za-z]{2,24}$")),
            "ip": _vote(None, value.rlike(r"^(?:0|127|255)\.")),
            "card": _vote(value.rlike("^[2-6]"), value.rlike("^[01]")),
            "phone": _vote(digits.between(10, 13)),
            "local_phone": _vote(value.rlike(r"^\(?[2-9]")),
            "iban": _vote(F.length(F.regexp_replace(value, r"\x20", "")).between(15, 34)),
            "secret": _vote(value.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), digits < 3),
            "hidden_email": _vote(value.rlike(r"[A-Za-z]{2,24}$")),
            "ip6": _vote(value.rlike(":")),
        },
        _vote(),
    )
    check = _by_kind(
        kind,
        {
            "card": _vote(variety > 3, variety <= 2),
            "secret": _vote(variety >= 10, variety < 8),
            "phone": _vote(None, variety <= 4),
            "local_phone": _vote(None, variety <= 4),
        },
        _vote(),
    )
    gazetteer = _by_kind(kind, {k: _vote(value.rlike(p)) for k, p in GAZETTEER.items()}, _vote())
    return F.struct(
        span.alias("span"),
        shape.alias("v_shape"),
        check.alias("v_check"),
        gazetteer.alias("v_gazetteer"),
        _vote(told).alias("v_telling"),
        _vote(None, misled).alias("v_misleading"),
        _vote(None, (edge(before) == "word") | (edge(after) == "word")).alias("v_edge"),
        kind.alias("kind"),
        F.least(F.floor(F.log2(F.length(value))), F.lit(8)).cast("string").alias("length"),
        F.floor(F.lit(4) * digits / F.length(value)).cast("string").alias("digits"),
        F.least(F.floor(variety / 4), F.lit(6)).cast("string").alias("variety"),
        edge(before).alias("before"),
        edge(after).alias("after"),
        telling.cast("string").alias("telling"),
        misled.cast("string").alias("misleading"),
    )


def candidates(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with arrays of base spans and of candidates with votes and features."""
    body = text_or_empty(text)
    with_base = computed_once(docs, **{prefix + "base": base_spans(body)})
    further = computed_once(with_base, **{prefix + "further": proposed_spans(body, F.col(prefix + "base"))})
    every = F.concat(F.col(prefix + "base"), F.col(prefix + "further"))
    return computed_once(further, **{prefix + "facts": F.transform(every, _facts)}).drop(prefix + "further")


@dataclass
class SpanModel:
    """Labeler reliabilities (true and false positive rate by labeler) and classifier weights."""

    rates: dict[str, tuple[float, float]] = field(default_factory=dict)
    weights: dict[tuple[str, str], float] = field(default_factory=dict)
    intercept: float = -1.0

    def score(self, fact: Column) -> Column:
        total = F.lit(self.intercept)
        for name in FEATURES:
            own = {v: w for (n, v), w in self.weights.items() if n == name}
            total = total + _by_kind(fact[name], {v: F.lit(w) for v, w in own.items()}, F.lit(0.0))
        return total


def reliabilities(rows: list[dict], rounds: int = 60) -> tuple[dict, list[float]]:
    """Expectation-maximisation on counted vote patterns.

    Labelers are taken as independent given the truth; an abstention says nothing.
    Returns each labeler's (P(1 | personal), P(1 | not)) and every row's posterior.
    """
    post = []
    for r in rows:
        votes = [r[v] for v in LABELERS if r[v] >= 0]
        post.append((sum(votes) + 1.0) / (len(votes) + 2.0))
    rates: dict[str, tuple[float, float]] = {}
    for _ in range(rounds):
        prior: dict[str, list[float]] = defaultdict(lambda: [1.0, 2.0])
        for r, p in zip(rows, post):
            prior[r["kind"]][0] += p * r["n"]
            prior[r["kind"]][1] += r["n"]
        for v in LABELERS:
            # The starting counts say that a labeler is right nine times in ten.
            hit, real, false, rest = 9.0, 10.0, 1.0, 10.0
            for r, p in zip(rows, post):
                if r[v] >= 0:
                    real, rest = real + p * r["n"], rest + (1 - p) * r["n"]
                    hit, false = hit + p * r["n"] * r[v], false + (1 - p) * r["n"] * r[v]
            rates[v] = (min(max(hit / real, 0.01), 0.99), min(max(false / rest, 0.01), 0.99))
        for i, r in enumerate(rows):
            share = min(max(prior[r["kind"]][0] / prior[r["kind"]][1], 0.02), 0.98)
            odds = math.log(share / (1 - share))
            for v in LABELERS:
                if r[v] >= 0:
                    a, b = rates[v]
                    odds += math.log(a / b) if r[v] else math.log((1 - a) / (1 - b))
            post[i] = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
    return rates, post


def fit(counts: list[dict], ridge: float = 1.0, steps: int = 25) -> SpanModel:
    """The model of counted patterns; ``n`` is the count of a row."""
    if not counts:
        return SpanModel()
    rates, post = reliabilities(counts)
    names = sorted({(f, r[f]) for r in counts for f in FEATURES})
    place = {name: i + 1 for i, name in enumerate(names)}
    x = np.zeros((len(counts), len(names) + 1))
    x[:, 0] = 1
    for i, r in enumerate(counts):
        x[i, [place[f, r[f]] for f in FEATURES]] = 1
    n, y, w = np.array([r["n"] for r in counts], float), np.array(post), np.zeros(len(names) + 1)
    keep = np.full(len(w), ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + keep * w
        bend = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(keep)
        move = np.linalg.solve(bend, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return SpanModel(rates, {k: float(w[i]) for k, i in place.items()}, float(w[0]))


def train(found: DataFrame, facts: str = "facts") -> SpanModel:
    """Fit on the candidates of all rows of a stored table of ``candidates``."""
    one = found.select(F.explode(facts).alias("f"))
    keys = [*LABELERS, *FEATURES]
    counted = one.groupBy(*[F.col("f")[k].alias(k) for k in keys]).agg(F.count("*").alias("n"))
    return fit(sorted((r.asDict() for r in counted.collect()), key=lambda r: [str(r[k]) for k in keys]))


def _accepted(model: SpanModel, base: Column, facts: Column) -> Column:
    """Base spans and the candidates the classifier accepts, by start and then kind."""
    more = F.filter(facts, lambda f: ~f["kind"].isin(*BASE) & (model.score(f) > 0))
    return F.sort_array(F.concat(base, F.transform(more, lambda f: f["span"])))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ","
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of base spans, their digest, and all spans of each row."""
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = materialize(candidates(slim, "text").drop("text"), "pii-candidates")
    model = train(found)
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(_accepted(model, F.col("base"), F.col("facts"))).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by its kind in brackets."""

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, tag)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, begin, step, finish))


def redact(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """All rows with the spans in ``text`` masked; ``length`` names a column for its new length.

    Null texts stay null.
    """
    prefix = fresh_name([c[: len("pii_")] for c in docs.columns], "pii_")
    found = materialize(candidates(docs, text, prefix), "pii-rows")
    model = train(found, prefix + "facts")
    spans = _accepted(model, F.col(prefix + "base"), F.col(prefix + "facts"))
    ready = computed_once(found, **{prefix + "spans": spans})
    clean = computed_once(ready, **{prefix + "clean": masked(F.col(f"`{text}`"), F.col(prefix + "spans"))})
    new = {text: F.col(prefix + "clean")}
    if length:
        new[length] = F.length(prefix + "clean").cast(docs.schema[length].dataType)
    return clean.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
