"""SQL checks of the queries that SQL can express, written for DuckDB."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH RECURSIVE item AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
    array_to_string(list_slice(words, start, start + least(10, len(words)) - 1), ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS start FROM item WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_window
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), doc_window AS (
  SELECT doc_id, size, start, array_to_string(list_slice(words, start, start + size - 1), ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, greatest(1, len(words) - size + 2))) AS start FROM doc, sizes)
), found AS (
  SELECT doc_id, item_id, start, d.size FROM doc_window d JOIN item_window i ON d.win = i.win AND d.size = i.size
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + size)) AS word FROM (SELECT DISTINCT doc_id, start, size FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LINES = rf"""
WITH line AS (
  SELECT doc_id, i, lines[i] AS line,
    translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE doc_id < keeper)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR doc_id >= keeper), '')) AS kept_sha256
FROM line LEFT JOIN repeated USING (key) GROUP BY doc_id
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS joint FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT u, v FROM pair JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v WHERE 100 * joint >= 75 * (a.n + b.n - joint)
), arc AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM words UNION SELECT reach.doc_id, arc.v FROM reach JOIN arc ON arc.u = reach.other
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""

_COMMON = (
    "the of and to in a is that for it was on with as are this by be de la le les et des en un une du que est der die und den von "
    "zu das mit dem ein el los las del con por se y"
).split()


def quality_rules() -> str:
    """Base rules and both divergences, written with lists."""
    text = "coalesce(text, '')"
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    common = ", ".join(f"len(list_filter(low, lambda x: x = '{w}'))" for w in _COMMON)
    cells = {"ch": 6, "cw": len(_COMMON) + 1}
    sums = ", ".join(f"sum({n}[{i}]) + 0.5 AS {n}{i}" for n, size in cells.items() for i in range(1, size + 1))
    parts = []
    for n, size in cells.items():
        total = " + ".join(f"{n}{i}" for i in range(1, size + 1))
        parts.append(f"[{', '.join(f'{n}{i} / ({total})' for i in range(1, size + 1))}] AS q_{n}")

    def js(n: str) -> str:
        term = f"CASE WHEN {n}[i] > 0 THEN ({n}[i] / t_{n}) * log2(2 * ({n}[i] / t_{n}) / (({n}[i] / t_{n}) + q_{n}[i])) ELSE 0 END"
        back = f"q_{n}[i] * log2(2 * q_{n}[i] / (q_{n}[i] + {n}[i] / t_{n}))"
        return f"coalesce(CASE WHEN t_{n} > 0 THEN list_sum(list_transform(range(1, {cells[n] + 1}), lambda i: {term} + {back})) / 2 ELSE 0 END, 0)"

    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, {text} AS text, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split({text}, chr(10)), lambda x: trim(x, {blank}) <> '') AS lines FROM documents
), window_ AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 6))) AS i FROM d)
), twin AS (SELECT doc_id, win FROM window_ GROUP BY ALL HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM window_ JOIN twin USING (doc_id, win)) GROUP BY doc_id
), base AS (
  SELECT doc_id, lang, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    list_transform(w, lambda x: lower(x)) AS low
  FROM d LEFT JOIN repeated USING (doc_id)
), class AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS c1, length(regexp_replace(text, '[^0-9]', '', 'g')) AS c2,
    length(regexp_replace(text, '[^.,;:!?]', '', 'g')) AS c3, [{common}] AS listed FROM base
), counted AS (
  SELECT *, [c1, c2, c3, n_symbols, word_chars - c1 - c2 - c3 - n_symbols, length(text) - word_chars] AS ch,
    list_append(listed, n_words - list_sum(listed)) AS cw, length(text) AS t_ch, n_words AS t_cw FROM class
), reference AS (
  SELECT lang, {', '.join(parts)} FROM (SELECT lang, {sums} FROM counted WHERE NOT base_failed GROUP BY lang)
), judged AS (SELECT *, {js('ch')} AS js_ch, {js('cw')} AS js_cw FROM counted LEFT JOIN reference USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n_words < 50 OR (js_ch <= 0.05 + 2.0 / word_chars AND js_cw <= 0.04 + 4.0 / n_words)) AS kept
FROM judged
"""

ARCHIVED_PAGES = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM rows WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, strlen(rows.html) AS payload_bytes, sha256(rows.html) AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM rows LEFT JOIN firsts ON rows.html = firsts.html
"""
