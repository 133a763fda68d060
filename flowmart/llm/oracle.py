"""The same results as DuckDB SQL, for the queries that SQL can state."""

from __future__ import annotations

from flowmart.llm.licences import KNOWN, SPELLINGS
from flowmart.llm.quality import (
    DUP_CHARACTERS,
    DUP_LINE_RATIO,
    LATIN,
    MAX_REPEAT_PERCENT,
    MIN_WORDS,
    OTHER_LETTERS,
    OTHER_STOP_WORDS,
    OWN_LATIN,
    RULES,
    STOP_WORD_RATIO,
    STOP_WORDS,
)

_WORDS = r"list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    others = ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS, *OTHER_STOP_WORDS}))
    count = lambda letters: f"len(regexp_extract_all(t, '{letters}'))"
    latin, own = count(f"[{LATIN}]"), count(f"[{OWN_LATIN}]")
    known = f"len(list_filter(ws, lambda w: lower(trim(w, '.,;:!?\"''()')) IN ({others})))"
    low = next(rule.low for rule in RULES if rule.name == STOP_WORD_RATIO)
    exceptions = {
        STOP_WORD_RATIO: f"""{count(r'\p{L}')} > 2 * {latin} OR CAST({latin} - {own} AS double) > {latin} * {OTHER_LETTERS}::double
      OR CAST({known} AS double) >= n_words * {low}::double""",
        DUP_LINE_RATIO: f"CAST(line_chars - different_chars AS double) <= line_chars * {DUP_CHARACTERS}::double",
    }
    rules = []
    for rule in RULES:
        if rule.low is not None:
            rules.append(f"CAST({rule.numerator} AS double) >= CAST({rule.denominator} AS double) * {rule.low}::double")
        if rule.high is not None:
            rules.append(f"CAST({rule.numerator} AS double) <= CAST({rule.denominator} AS double) * {rule.high}::double")
        if rule.name in exceptions:
            rules[-1] = f"({rules[-1]} OR {exceptions[rule.name]})"
    return f"""WITH texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, {_WORDS} AS ws,
    list_filter(string_split(t, chr(10)), lambda l: translate(l, {_WHITE}, '') <> '') AS ls FROM texts),
grams AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM split)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(3) x(k) GROUP BY r),
counted AS (SELECT doc_id, t, ws, coalesce(list_sum(list_transform(ls, lambda l: length(l))), 0) AS line_chars,
    coalesce(list_sum(list_transform(list_distinct(ls), lambda l: length(l))), 0) AS different_chars, len(ws) AS n_words, CAST(length(translate(t, {_WHITE}, '')) AS bigint) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS bigint) AS n_symbols,
    CAST(len(ls) AS bigint) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines,
    CAST(len(list_filter(ls, lambda l: l LIKE '%...' OR l LIKE '%…')) AS bigint) AS n_ellipsis_lines,
    coalesce(n, 0) AS n_repeat_words,
    CAST(len(list_filter(ws, lambda w: lower(trim(w, '.,;:!?"''()')) IN ({stops}))) AS bigint) AS n_stop_words,
    CAST(len(list_filter(ws, lambda w: regexp_matches(w, '\\p{{L}}'))) AS bigint) AS n_letter_words
  FROM split LEFT JOIN repeated USING (r)),
base AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM counted)
SELECT * EXCLUDE (t, ws, line_chars, different_chars), NOT base_failed AND {' AND '.join(rules)} AS kept FROM base"""


def _licences() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"

    def canonical(text: str) -> str:
        kept = f"list_filter(string_split(lower({text}), chr(10)), lambda l: NOT regexp_matches(l, '^[^\\p{{L}}\\p{{N}}©]*(copyright|©|\\(c\\) |all rights reserved)'))"
        level = f"' ' || regexp_replace(array_to_string({kept}, ' '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
        for variant, usual in SPELLINGS:
            level = f"replace({level}, ' {variant} ', ' {usual} ')"
        return f"trim(regexp_replace({level}, ' +', ' ', 'g'))"

    known = " UNION ALL ".join(f"SELECT {quoted(name)} AS licence, {quoted(text)} AS t" for name, text in KNOWN)
    return f"""WITH known AS (SELECT c, min(licence) AS licence FROM (SELECT licence, {canonical('t')} AS c FROM ({known}))
  WHERE c <> '' GROUP BY c),
texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
whole AS (SELECT r, doc_id, {canonical('t')} AS c FROM texts),
lines AS (SELECT r, {canonical('l')} AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM texts)),
found AS (SELECT r, list_sort(list_distinct(list(licence))) AS notices FROM lines JOIN known USING (c) GROUP BY r)
SELECT doc_id, CASE WHEN w.c <> '' THEN sha256(w.c) END AS digest, licence, coalesce(notices, []) AS notices
FROM whole w LEFT JOIN known USING (c) LEFT JOIN found USING (r)"""


def _lines() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM texts),
keyed AS (SELECT *, translate(trim(l, {_WHITE}), '{upper}', '{lower}') AS key FROM lines),
repeated AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT r, doc_id, l, i, coalesce(doc_id <> first, false) AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""


_NEGATIVES = """WITH sound AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::double)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    CAST(list_inner_product(a.q, c.q) AS bigint) AS score
  FROM sound a JOIN sound c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS integer) AS rank, s.id AS negative_id, positive_score,
  s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER best <= 3"""

ORACLE: dict[str, str] = {"op11_line_dedup": _lines(), "op12_hard_negatives": _NEGATIVES, "op2_quality_rules": _quality(), "op9_license_scans": _licences()}
