"""SQL twins of the corpus queries, where SQL can express them (DuckDB)."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

# Stop words and thresholds are written out here, apart from the operator's own.
STOPS = (
    "the and of to in that is was for it with as on be at by this are from or an a "
    "der die das und ist nicht von zu den mit sich auf für im dem ein eine auch "
    "le la les de des et un une du en que qui dans pas par pour est au "
    "el los las y por una su para no con lo se al del"
)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]] AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(5) t(k) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(cover.n, 0) AS n_repeat_words,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest,
    len(regexp_extract_all(text, '[!¡]')) AS shouts,
    len(regexp_extract_all(array_to_string(w, ''), '\p{{Lu}}')) AS capitals,
    len(regexp_extract_all(array_to_string(w, ''), '[0-9]')) AS digits,
    len(list_filter(w, lambda x: list_contains(string_split('{STOPS}', ' '), lower(x)))) AS stops,
    len(list_distinct(w)) AS different,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS ellipses,
    len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-•*·]\s'))) AS bullets
  FROM d LEFT JOIN cover USING (r)),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    list_filter([
      CASE WHEN n_words = 0 OR word_chars / n_words < 2 OR word_chars / n_words > 14 THEN 'word_length' END,
      CASE WHEN longest > 1000 THEN 'longest_word' END,
      CASE WHEN n_symbols / n_words > 0.1 THEN 'symbols' END,
      CASE WHEN shouts / n_words > 0.5 THEN 'shouting' END,
      CASE WHEN capitals / word_chars > 0.4 THEN 'capitals' END,
      CASE WHEN digits / word_chars > 0.5 THEN 'digits' END,
      CASE WHEN n_words >= 40 AND stops / n_words < 0.02 THEN 'stop_words' END,
      CASE WHEN n_words >= 20 AND ellipses / n_lines > 0.3 THEN 'ellipsis_lines' END,
      CASE WHEN n_words >= 20 AND bullets / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_words >= 20 AND n_dup_lines / n_lines > 0.4 THEN 'dup_lines' END,
      CASE WHEN n_words >= 40 AND different / n_words < 0.1 THEN 'distinct_words' END
    ], lambda x: x IS NOT NULL) AS failed
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  base_failed, NOT base_failed AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
FROM v
"""


LEVEL_SQL = """
{name} AS (
  SELECT {keys}, tokens, greatest(least(can::DOUBLE, coalesce(max(height) OVER f, 0.0) * weight), 0.0) AS given
  FROM (
    SELECT *, CASE WHEN weight_all - weight_before > 0 THEN (budget - can_before) / (weight_all - weight_before) END AS height
    FROM (
      SELECT *, sum(weight) OVER (PARTITION BY {parent}) AS weight_all,
        coalesce(sum(can) OVER e, 0) AS can_before, coalesce(sum(weight) OVER e, 0) AS weight_before
      FROM (
        SELECT {columns}, sum(l.tokens) AS tokens, 2 * sum(l.tokens) AS can, any_value({weight}) AS weight,
          any_value(p.given) AS budget
        FROM leaf l JOIN {above} p ON {on} GROUP BY {columns})
      WINDOW e AS (PARTITION BY {parent} ORDER BY can / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
  WINDOW f AS (PARTITION BY {parent}))"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len({WORDS}) AS tokens,
    md5(coalesce(text, '')) AS digest,
    'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % 4) AS domain
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM d WHERE tokens > 0 GROUP BY ALL),
root AS (SELECT floor(sum(tokens))::DOUBLE AS given FROM leaf),""" + ",".join(
    [
        LEVEL_SQL.format(
            name="level1", keys="domain", columns="l.domain", parent="1", level="domain", above="root", on="true",
            weight="CASE l.domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END",
        ),
        LEVEL_SQL.format(
            name="level2", keys="domain, lang", columns="l.domain, l.lang", parent="domain", level="lang",
            above="level1", on="l.domain = p.domain",
            weight="CASE l.lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END",
        ),
        LEVEL_SQL.format(
            name="level3", keys="domain, lang, source", columns="l.domain, l.lang, l.source", parent="domain, lang",
            level="source", above="level2", on="l.domain = p.domain AND l.lang = p.lang", weight="1",
        ),
    ]
) + """,
goal AS (SELECT domain, lang, source, tokens AS size, floor(given + 1e-6)::BIGINT AS target FROM level3),
placed AS (
  SELECT d.*, target // size AS epochs, target % size AS rest,
    md5('mix-1/' || (target // size)::BIGINT || '/' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM d JOIN goal USING (domain, lang, source) WHERE d.tokens > 0),
run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, tokens, digest
    ROWS UNBOUNDED PRECEDING) - tokens AS gone
  FROM placed)
SELECT doc_id, domain, lang, source, e::INTEGER AS epoch, tokens::BIGINT AS tokens, tokens::BIGINT AS taken
FROM (SELECT *, unnest(range(epochs::BIGINT)) AS e FROM placed)
UNION ALL
SELECT doc_id, domain, lang, source, epochs::INTEGER, tokens::BIGINT, least(tokens, rest - gone)::BIGINT
FROM run WHERE gone < rest
"""


def registry() -> dict[str, str]:
    return {"op2_mix_sources": MIXING, "op5_quality_rules": QUALITY}
