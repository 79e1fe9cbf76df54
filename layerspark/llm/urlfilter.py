"""URL verdicts: domain rules first, then host words scored by naive Bayes.

Host names are split at dots and hyphens, and each label into words by Viterbi over
a unigram model: of all ways to cut the label, the most probable. Words are counted
over the texts of all pages and joined by a built-in lexicon; an unknown piece
costs more with every letter. The words of host and path then go to a multinomial
naive Bayes model. It is trained on all urls: those with a word of the lexicon of
unwanted sites count as unwanted, which lets it learn the other words of their hosts. In a host, a word of that
lexicon weighs ``LEXICON_ODDS`` at least.

Both models have a bounded vocabulary (the most frequent words, ``VOCABULARY``);
every url is counted and judged.

Defined results: a null url, or one without ``://``, has an empty host and path, no
words and no rule, and is allowed. Repeated rows are judged one by one; a null key
stays null; columns beside those named are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import most_frequent
from layerspark.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VOCABULARY = 50_000
LONGEST_WORD = 24


@dataclass(frozen=True)
class Rule:
    """``host/path`` prefix that fits its host and all subdomains."""

    prefix: str
    verdict: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)

# Words of unwanted sites, and frequent words of ordinary host names.
UNWANTED = frozenset(
    "casino casinos poker bet bets betting gamble gambling jackpot slots lottery roulette "
    "pill pills viagra cialis pharmacy drugs porn porno xxx sex adult nude escort camgirl "
    "ad ads adserver advert banner popup track tracker tracking click clicks spam malware "
    "phishing warez crack keygen torrent replica loan loans payday".split()
)
ORDINARY = (
    "www web mail blog news shop store home page site online free best cheap win money game games "
    "the my our your and for with info data book books music photo video map maps forum wiki docs "
    "help support cloud app apps dev test example com net org edu gov co uk de fr es en it"
).split()
LEXICON_COUNT = 1000
LEXICON_ODDS = 8.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, or null."""
    fits = []
    for rule in sorted(rules, key=lambda r: -len(r.prefix)):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        fits.append(F.when(inside & path.startswith(rule.path), F.lit(rule.prefix)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


class Segmenter:
    """Viterbi over a unigram model of words."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) or 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(total) + math.log(10)

    def words(self, label: str) -> list[str]:
        best, cut = [0.0], [0]
        for end in range(1, len(label) + 1):
            options = []
            for start in range(max(0, end - LONGEST_WORD), end):
                piece = label[start:end]
                # An unknown piece is rarer than any word, and ten times more with each letter.
                cost = self.cost.get(piece, self.unknown + 2.3 * len(piece))
                options.append((best[start] + cost, start))
            cost, start = min(options)
            best.append(cost)
            cut.append(start)
        out, end = [], len(label)
        while end:
            out.append(label[cut[end] : end])
            end = cut[end]
        return out[::-1]


def word_counts(pages: DataFrame, text: str) -> dict[str, int]:
    """Counts of the most frequent words over all pages, with the lexicon added."""
    body = F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(body, "[^a-z]+")).alias("w"))
    words = words.filter(F.length("w").between(2, LONGEST_WORD)).groupBy("w").count()
    words = materialize(words, "url-vocabulary")
    counts = {r["w"]: r["count"] for r in most_frequent(words, VOCABULARY).collect()}
    for w in (*UNWANTED, *ORDINARY):
        counts[w] = counts.get(w, 0) + LEXICON_COUNT
    return counts


def _tokenizer(counts: dict[str, int]):
    segmenter = Segmenter(counts)

    @lru_cache(maxsize=100_000)
    def of_label(label: str) -> tuple[str, ...]:
        return tuple(segmenter.words(label))

    def tokens(host: str, path: str) -> list[str]:
        out = []
        for label in re.split(r"[^a-z]+", host):
            out += of_label(label)
        return out + ["/" + p for p in re.split(r"[^a-z]+", path.lower()) if p]

    return tokens


def tokenized(urls: DataFrame, counts: dict[str, int]) -> DataFrame:
    """``urls`` (key, host, path, rule) with the words of host and path."""
    schema = urls.drop("words").schema.simpleString()
    shared = urls.sparkSession.sparkContext.broadcast(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizer(shared.value)
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            pairs = zip(batch.column(at["host"]).to_pylist(), batch.column(at["path"]).to_pylist())
            words = pa.array([tokens(h, p) for h, p in pairs], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, words], names=[*batch.schema.names, "words"])

    return urls.mapInArrow(add, schema.removeprefix("struct<").removesuffix(">") + ",words:array<string>")


def bayes(tokens: DataFrame, smoothing: float = 1.0) -> tuple[dict[str, float], float]:
    """Log odds for unwanted by word, and of the classes, from all rows of a stored table."""
    unwanted = F.exists("words", lambda w: F.regexp_replace(w, "^/", "").isin(*sorted(UNWANTED)))
    labelled = tokens.select("words", unwanted.alias("bad"))
    classes = {r["bad"]: r["count"] for r in labelled.groupBy("bad").count().collect()}
    words = labelled.select(F.explode("words").alias("w"), "bad").groupBy("w").agg(
        F.count_if("bad").alias("bad"), F.count("*").alias("n")
    )
    words = materialize(words, "url-tokens")
    size, bad_all, all_ = words.agg(
        F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    odds = {}
    for r in most_frequent(words, VOCABULARY, "n").collect():
        bad = (r["bad"] + smoothing) / (bad_all + smoothing * size)
        good = (r["n"] - r["bad"] + smoothing) / (all_ - bad_all + smoothing * size)
        odds[r["w"]] = math.log(bad / good)
    # What the lexicon says must not depend on how often a table shows a word.
    for w in UNWANTED:
        odds[w] = max(odds.get(w, 0.0), LEXICON_ODDS)
    prior = math.log((classes.get(True, 0) + smoothing) / (classes.get(False, 0) + smoothing))
    return odds, prior


def judge(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    text: str = "html",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Host, path, rule, verdict, score and words of each row."""
    host, path = split_url(F.col(url))
    parts = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    stored = materialize(tokenized(parts, word_counts(pages, text)), "url-words")
    odds, prior = bayes(stored)
    shared = pages.sparkSession.sparkContext.broadcast(odds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            words = batch.column(batch.schema.get_field_index("words")).to_pylist()
            total = pa.array([prior + sum(of.get(w, 0.0) for w in ws) if ws else -1.0 for ws in words], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, total], names=[*batch.schema.names, "block_log_odds"])

    fields = stored.schema.simpleString().removeprefix("struct<").removesuffix(">")
    scored = stored.mapInArrow(score, fields + ",block_log_odds:double")
    verdict = F.when(F.col("block_log_odds") > 0, "block").otherwise("allow")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.prefix, rule.verdict).otherwise(verdict)
    return scored.select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "block_log_odds",
        F.array_join("words", " ").alias("words"),
    )
