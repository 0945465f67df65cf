"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP3 = f"""
WITH t AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       text_sha256
FROM t
WINDOW g AS (PARTITION BY text_sha256)
"""

OP6 = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, {SPACED_WORDS} AS w FROM documents
), m AS (
  SELECT doc_id, w, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM t
), g AS (
  SELECT doc_id, unnest(range(1, n_words - 1)) AS i, w FROM m WHERE n_words >= 3
), c AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id
), a AS (
  SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines
  FROM m LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *,
         CASE WHEN n_words < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
         + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
         + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END AS failed
  FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM f
"""

OP10 = f"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, len({SPACED_WORDS})::BIGINT AS size FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2] AS DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
  FROM t
), r AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS goal,
         coalesce(sum(source_size) OVER before, 0) * 2.0::DOUBLE AS used,
         sum(weight) OVER onward AS open
  FROM w
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), c AS (
  SELECT *, (goal - used) / open AS share FROM r
), l AS (
  SELECT arg_min(share, source_size / weight) AS level FROM c WHERE share * weight <= source_size * 2.0::DOUBLE
), g AS (
  SELECT source, source_size,
         CASE WHEN share * weight > source_size * 2.0::DOUBLE THEN source_size * 2.0::DOUBLE
              ELSE level * weight END AS target
  FROM c, l
), d AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.digest), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       ((floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) * size)::BIGINT AS taken
FROM d
"""

OP4 = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p(label, base, words, key_at, key_words) AS (VALUES
  @templates@
), found AS (
  SELECT doc_id, label, base, words, w, unnest(range(0 - key_at[1], len(w))) AS s, key_at, key_words
  FROM t, p
  WHERE list_has_all(w, flatten(key_words))
), hit AS (
  SELECT doc_id, label, base, s,
         len(list_filter(range(1, len(words) + 1), lambda k: s + k >= 1 AND w[s + k] = words[k])) / len(words)::DOUBLE AS likeness
  FROM found
  WHERE len(list_filter(range(1, len(key_at) + 1), lambda k: s + key_at[k] >= 0
            AND w[s + key_at[k] + 1 : s + key_at[k] + len(key_words[k])] = key_words[k])) = len(key_at)
), per AS (
  SELECT doc_id,
         count(*) FILTER (WHERE base) AS n_base,
         min(s) FILTER (WHERE base) AS first_word,
         max(s) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(likeness) AS score
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM t LEFT JOIN per USING (doc_id)
"""


OP9 = """
WITH t AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM t
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

OP11 = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT row, lang, source, term, count(*) AS n
  FROM (SELECT row, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), l AS (
  SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), dense AS (
  SELECT g.lang, g.source, l.term, l.n AS in_lang, coalesce(sum(t.n), 0) AS n
  FROM g JOIN l ON g.lang = l.lang
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = l.term
  GROUP BY ALL
), p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS p,
         1 + (1000000000::HUGEINT * (in_lang + 2)) // (sum(in_lang) OVER g + 2 * count(*) OVER g) AS q
  FROM dense WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), telling AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (FROM pairs UNION ALL FROM telling)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP13 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), y AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
  FROM d LEFT JOIN y ON d.doc_id = y.doc_id
), c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails GROUP BY part, failed
), o(before, f, rest) AS (
  SELECT '', '', 'ABCDE'
  UNION ALL
  SELECT before || f, substr(rest, i::INT, 1), replace(rest, substr(rest, i::INT, 1), '')
  FROM (SELECT before, f, rest, unnest(range(1, length(rest) + 1)) AS i FROM o WHERE rest <> '')
), s AS (
  SELECT a.before || a.f || coalesce(b.tail, '') AS filter_order, length(a.before) + 1 AS step, a.before, a.f
  FROM o a JOIN (SELECT before || f AS whole FROM o WHERE rest = '') z ON starts_with(z.whole, a.before || a.f)
  LEFT JOIN LATERAL (SELECT substr(z.whole, length(a.before) + 2) AS tail) b ON true
  WHERE a.f <> ''
), r AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT left_out AND NOT contains(failed, f)), 0) AS kept,
         coalesce(sum(n) FILTER (NOT left_out AND contains(failed, f)), 0) AS removed,
         coalesce(sum(n) FILTER (left_out AND contains(failed, f)), 0) AS redundant,
         coalesce(sum(n) FILTER (failed = f), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT left_out AND contains(failed, f)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT left_out AND contains(failed, f)), 0) AS toxic_lost
  FROM (SELECT s.*, c.*, translate(failed, before, '') <> failed AS left_out FROM c, s)
  GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""


def _license_rows() -> str:
    """The templates as SQL values."""
    from rxstrata.llm.license_scan import TEMPLATES

    def text_list(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    # the base phrases are spelled out: a wrong one in the package shows as a difference
    rows = [
        "('mit', true, ['mit', 'license'], [0], [['mit', 'license']])",
        "('apache', true, ['apache', 'license'], [0], [['apache', 'license']])",
        "('gpl', true, ['general', 'public', 'license'], [0], [['general', 'public', 'license']])",
    ]
    for t in TEMPLATES:
        if t.base:
            continue
        keys = t.mandatory()
        places = "[" + ", ".join(str(at) for at, _ in keys) + "]"
        phrases = "[" + ", ".join(text_list(p) for _, p in keys) + "]"
        rows.append(f"('{t.label}', {t.base}, {text_list(t.words)}, {places}, {phrases})")
    return ",\n  ".join(rows)


ORACLES = {
    "op3_exact_dedup": OP3,
    "op4_license_scan": OP4.replace("@templates@", _license_rows()),
    "op6_quality_rules": OP6,
    "op9_warc": OP9,
    "op10_mixing": OP10,
    "op11_topk_search": OP11,
    "op12_source_audit": OP12,
    "op13_filter_audit": OP13,
}
