"""Quality rules: a threshold table compiled into one projection.

Each document gets its measures (lengths, symbol, stop-word and line ratios), the
names of the rules it breaks and a verdict. All of it is built-in expressions.

Defined results: a null text counts as empty, so it has no words and fails the
base rule; empty and blank texts do the same. Repeated rows are judged one by
one. A null key stays null. Other columns of the input are not read by
``judge`` and are returned untouched by ``keep_good``, whatever their names. An
empty table gives an empty result.

Windows of five words are compared by a 64-bit hash of their words within one
document; two different windows of a text of n words collide with a chance of
about n * n / 2 ** 65.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerspark.llm.common import computed_once, fresh_name, let, text_or_empty, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in that is was for it with as on be at by this are from or an a "
    "der die das und ist nicht von zu den mit sich auf für im dem ein eine auch "
    "le la les de des et un une du en que qui dans pas par pour est au "
    "el los las y por una su para no con lo se al del"
).split()


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule when ``measure`` lies outside ``low`` to ``high``.

    ``from_words`` is the least number of words for which the rule is asked:
    ratios of very short texts say little.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


# Production thresholds. Ratios are per word unless they say otherwise.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("longest_word", "max_word_chars", None, 1000.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("shouting", "exclamation_ratio", None, 0.5),
    Rule("capitals", "capital_ratio", None, 0.4),
    Rule("digits", "digit_ratio", None, 0.5),
    Rule("stop_words", "stop_word_ratio", 0.02, None, 40),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3, 20),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9, 20),
    Rule("dup_lines", "dup_line_ratio", None, 0.4, 20),
    Rule("distinct_words", "distinct_word_ratio", 0.1, None, 40),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more.

    A hash of each window is tested for repeats first. Only texts with some pay
    for the sort that finds their places.
    """
    last = F.size(words) - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(placed, counted)

    def counted(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)),
        )
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("before"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, p: F.struct(
                p.alias("before"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["before"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    zero = F.lit(0).cast("long")
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(covered(h)))
    return F.when(last < 1, zero).otherwise(found)


def _measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    solid = F.array_join(words, "")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(solid).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeat_words(words),
        "max_word_chars": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)),
        "n_exclamations": F.regexp_count(solid, F.lit("[!¡]")),
        "n_capitals": F.regexp_count(solid, F.lit(r"\p{Lu}")),
        "n_digits": F.regexp_count(solid, F.lit("[0-9]")),
        "n_stops": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_ellipsis": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        "n_bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-•*·]\s"))),
    }


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "exclamation_ratio": ("n_exclamations", "n_words"),
    "capital_ratio": ("n_capitals", "word_chars"),
    "digit_ratio": ("n_digits", "word_chars"),
    "stop_word_ratio": ("n_stops", "n_words"),
    "distinct_word_ratio": ("n_distinct", "n_words"),
    "ellipsis_line_ratio": ("n_ellipsis", "n_lines"),
    "bullet_line_ratio": ("n_bullets", "n_lines"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def compile_rules(rules: tuple[Rule, ...], measures: dict[str, Column]) -> Column:
    """One array expression: the names of the rules that a row breaks."""
    broken = []
    for rule in rules:
        value, out = measures[rule.measure], F.lit(False)
        if rule.low is not None:
            out = out | (value < F.lit(rule.low))
        if rule.high is not None:
            out = out | (value > F.lit(rule.high))
        if rule.from_words:
            out = out & (measures["n_words"] >= rule.from_words)
        broken.append(F.when(out, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Key, counts, ``base_failed``, ``kept`` and ``failed_rules`` (comma-joined) of each row."""
    parts = docs.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text"))
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = computed_once(parts, words=words_of(F.col("text")), lines=lines)
    measured = computed_once(parts, **_measures(F.col("text"), F.col("words"), F.col("lines")))
    measures = {n: F.col(n) for n in measured.columns} | {n: _ratio(*pair) for n, pair in RATIOS.items()}
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = compile_rules(rules, measures)
    return measured.select(
        "doc_id",
        *COUNTS,
        base.alias("base_failed"),
        (~base & (F.size(failed) == 0)).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
    )


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes, with their own columns only; no shuffle.

    The whole row travels as one struct beside the measures, so its column names
    cannot clash with theirs.
    """
    row = fresh_name(docs.columns, "whole_row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    carried = packed.select(row, F.col(row)[text].alias("text"))
    judged = judge(carried.withColumnRenamed(row, "doc_id"), "doc_id", "text", rules)
    return judged.filter("kept").select("doc_id.*")
