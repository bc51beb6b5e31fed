"""SQL counterparts of the text queries, where SQL can express them."""

# Written out by hand rather than built from the template, so that it checks it.
_ESCAPES = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in _ESCAPES:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), moves AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS n,
    lead(role) OVER w IS NULL AS is_last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, coalesce(before, 'start') || '>' || role IN (
    'start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant'
  ) AS allowed FROM moves
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
  CAST(sum(12 + length(replace({_escaped("role")}, chr(10), '\\n')) + 1 + length({_escaped("text")}) + 11) AS BIGINT)
    AS formatted_chars,
  bool_and(allowed) AS valid,
  bool_and(allowed) AND bool_or(is_last AND role = 'assistant') AS complete
FROM judged GROUP BY conv_id
"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINES = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n FROM split
), keyed AS (
  SELECT r, doc_id, line, n, translate(trim(line, {_WHITE}), {_UPPER}, {_LOWER}) AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.r, k.doc_id, k.line, k.n, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY n), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

_FILTERS = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"

FILTER_AUDIT = f"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), failed AS (
  SELECT f.part,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN f.doc_id > first_id THEN 'E' ELSE '' END AS fails,
    coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM facts f LEFT JOIN labels l ON f.doc_id = l.doc_id
), masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM failed GROUP BY part, fails
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM {_FILTERS} a(f), {_FILTERS} b(f), {_FILTERS} c(f), {_FILTERS} d(f), {_FILTERS} e(f)
  WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS INTEGER), 1) AS f,
    substr(filter_order, 1, CAST(step AS INTEGER) - 1) AS earlier
  FROM orders, range(1, 6) s(step)
), judged AS (
  SELECT m.part, s.filter_order, s.step, s.f, m.fails, m.n, m.n_good, m.n_toxic,
    contains(m.fails, s.f) AS here,
    s.earlier <> '' AND m.fails <> '' AND regexp_matches(m.fails, '[' || s.earlier || '_]') AS before
  FROM masks m, steps s
), counts AS (
  SELECT part, filter_order, step, f,
    CAST(sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN here AND NOT before THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN here AND before THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN here AND NOT before THEN n_good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN here AND NOT before THEN n_toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded
), counts AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, range(1, 5) t(k) WHERE i + k - 1 <= len(words)
  GROUP BY lang, k, array_to_string(words[i : i + k - 1], ' ') HAVING count(*) >= 30
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k >= 2
), covered AS (
  SELECT DISTINCT longer.lang, inner_one.phrase
  FROM (
    SELECT lang, k, a, words, m, i FROM candidates, range(2, 4) t(m), range(1, 4) s(i) WHERE m < k AND i + m - 1 <= k
  ) longer
  JOIN candidates inner_one ON inner_one.lang = longer.lang
    AND inner_one.phrase = array_to_string(longer.words[longer.i : longer.i + longer.m - 1], ' ')
  WHERE 100 * CAST(longer.a AS HUGEINT) >= 80 * CAST(inner_one.a AS HUGEINT)
), cuts AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.j,
    CAST((2000000 * CAST(c.a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : c.j], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.j + 1 : c.k], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cuts
), listed AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
    w.phrase, a, l, r, n, score
  FROM lowest w JOIN totals t ON t.lang = w.lang
  LEFT JOIN covered v ON v.lang = w.lang AND v.phrase = w.phrase
  WHERE place = 1 AND v.phrase IS NULL
)
SELECT lang, rank, phrase, a, l, r, n, score FROM listed WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op3_chat_formatting": CHAT, "op11_line_dedup": LINES, "op12_filter_audit": FILTER_AUDIT,
    "op13_collocations": COLLOCATIONS,
}
