"""DuckDB SQL of the queries that SQL can express."""

_TERMS = r"'[^\x{0}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+'"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH = f"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, {_TERMS})) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
asked AS (
    SELECT DISTINCT item_id, term FROM (
        SELECT item_id, unnest(regexp_extract_all({_LOWERED}, {_TERMS})) AS term FROM benchmark)),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
    SELECT item_id, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH parts AS (SELECT doc_id, string_split(ifnull(text, ''), chr(10)) AS p FROM documents),
cut AS (SELECT doc_id, unnest(p) AS line, unnest(range(len(p))) AS i FROM parts),
keyed AS (
    SELECT doc_id, i, line, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM cut),
common AS (SELECT k AS c FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c) AS n_dropped,
       sha256(ifnull(string_agg(line, chr(10) ORDER BY i) FILTER (c IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON c = k GROUP BY doc_id
"""

_WORD = r"'[^\x20\x09-\x0D]+'"

QUALITY = f"""
WITH cut AS (
    SELECT doc_id, ifnull(text, '') AS text, regexp_extract_all(ifnull(text, ''), {_WORD}) AS w,
           list_filter(string_split(ifnull(text, ''), chr(10)), lambda x: regexp_matches(x, {_WORD})) AS l
    FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM cut),
windows AS (
    SELECT doc_id, i, word AS a, lead(word) OVER own AS b, lead(word, 2) OVER own AS c FROM words
    WINDOW own AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
    SELECT doc_id, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
chars AS (
    SELECT doc_id, CAST(sum(length(word)) AS BIGINT) AS word_chars, count(DISTINCT word) AS kinds,
           count(*) FILTER (regexp_matches(word, '\\p{{L}}')) AS with_letter
    FROM words GROUP BY doc_id),
counted AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, ifnull(word_chars, 0) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, ifnull(n, 0) AS n_repeat_words,
           len(l) AS n_lines, length(text) AS size, ifnull(kinds, 0) AS kinds, ifnull(with_letter, 0) AS with_letter,
           greatest(len(w), 1) AS held
    FROM cut LEFT JOIN chars USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > 0.1e0 * word_chars OR word_chars > 25 * held OR word_chars < 2 * held
            OR n_dup_lines > 0.3e0 * n_lines OR with_letter < 0.6e0 * held OR kinds < 0.05e0 * held
            OR size > 40000 * greatest(n_lines, 1)) AS kept
FROM judged
""".replace("\\\\p", "\\p")

ORACLE: dict[str, str] = {"op5_line_dedup": LINES, "op10_quality_rules": QUALITY, "op11_max_sketch_search": SEARCH}
