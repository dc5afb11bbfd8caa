"""DuckDB SQL over the test tables for the queries that SQL can express."""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _fence(metric: str, sign: int, factor: int, slack: int) -> str:
    q = "q3" if sign > 0 else "q1"
    return (f"max(CASE WHEN metric = '{metric}' THEN {q} {'+' if sign > 0 else '-'} {factor} * "
            f"greatest(q3 - q1, {slack}) END)")


_RULES = [("symbols", "symbol_ratio", 1, 3, 10000), ("dup_lines", "dup_line_ratio", 1, 4, 75000),
          ("repeats", "repeat_ratio", 1, 4, 75000), ("long_words", "mean_word", 1, 6, 500),
          ("short_words", "mean_word", -1, 6, 300)]
_FENCES = ", ".join(f"{_fence(m, s, f, k)} AS {n}" for n, m, s, f, k in _RULES)
_CHOSEN = ", ".join(f"(o.total * o.{n} + 200 * ((l.total * l.{n} + 200 * t.{n}) // (l.total + 200))) "
                    f"// (o.total + 200) AS {n}" for n, *_ in _RULES)
_BROKEN = ", ".join(f"CASE WHEN {m} {'>' if s > 0 else '<'} g.{n} THEN '{n}' END" for n, m, s, *_ in _RULES)

QUALITY_RULES_SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents
), tri AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d))
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM tri WHERE n > 1) GROUP BY doc_id
), f AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ln) AS BIGINT) AS n_lines,
         CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id
), m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols * 1000000 // greatest(word_chars, 1) AS symbol_ratio,
         n_dup_lines * 1000000 // greatest(n_lines, 1) AS dup_line_ratio,
         n_repeat_words * 1000000 // greatest(n_words, 1) AS repeat_ratio,
         word_chars * 1000 // greatest(n_words, 1) AS mean_word
  FROM f
), u AS (
  SELECT lang, source, metric, v, greatest(length(bin(v)) - 6, 0) AS s
  FROM (SELECT lang, source, unnest(['symbol_ratio', 'dup_line_ratio', 'repeat_ratio', 'mean_word']) AS metric,
               unnest([symbol_ratio, dup_line_ratio, repeat_ratio, mean_word]) AS v
        FROM m WHERE NOT base_failed)
), sk AS (
  SELECT lang, source, metric, (v >> s) << s AS v, count(*) AS n FROM u GROUP BY ALL
), lev AS (
  SELECT 2 AS lev, lang, source, metric, v, n FROM sk
  UNION ALL SELECT 1, lang, NULL, metric, v, sum(n) FROM sk GROUP BY lang, metric, v
  UNION ALL SELECT 0, NULL, NULL, metric, v, sum(n) FROM sk GROUP BY metric, v
), cum AS (
  SELECT *, sum(n) OVER (PARTITION BY lev, lang, source, metric ORDER BY v) AS below,
         sum(n) OVER (PARTITION BY lev, lang, source, metric) AS total FROM lev
), qs AS (
  SELECT lev, lang, source, metric, max(total) AS total,
         min(CASE WHEN below * 100 >= total * 25 THEN v END) AS q1,
         min(CASE WHEN below * 100 >= total * 75 THEN v END) AS q3
  FROM cum GROUP BY lev, lang, source, metric
), wide AS (
  SELECT lev, lang, source, max(total) AS total, {_FENCES} FROM qs GROUP BY lev, lang, source
), g AS (
  SELECT o.lang, o.source, {_CHOSEN}
  FROM wide o JOIN wide l ON l.lev = 1 AND o.lang IS NOT DISTINCT FROM l.lang JOIN wide t ON t.lev = 0
  WHERE o.lev = 2
), x AS (
  SELECT m.*, CASE WHEN base_failed THEN '' ELSE concat_ws(',', {_BROKEN}) END AS failed_rules
  FROM m LEFT JOIN g ON m.lang IS NOT DISTINCT FROM g.lang AND m.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM x
"""

LINE_DEDUP_SQL = r"""
WITH ln AS (
  SELECT doc_id AS d, unnest(range(len(string_split(text, chr(10))))) AS l, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL
), st AS (
  SELECT d, l, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS s FROM ln
), k AS (
  SELECT d, l, len(s) AS n, s FROM st WHERE len(s) >= 5
), w AS (
  SELECT d, l, n, unnest(s) AS w FROM k
), df AS (
  SELECT w, count(*) AS c FROM w GROUP BY w
), p AS (
  SELECT d, l, n, w, row_number() OVER (PARTITION BY d, l ORDER BY c, w) AS i FROM w JOIN df USING (w)
), pre AS (
  SELECT d, l, n, w FROM p WHERE i <= n - CAST(ceil(n * 80 / 100.0) AS BIGINT) + 1
), c AS (
  SELECT DISTINCT a.d AS ad, a.l AS al, b.d AS bd, b.l AS bl
  FROM pre a JOIN pre b ON a.w = b.w AND (a.d < b.d OR (a.d = b.d AND a.l < b.l))
   AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
), gone AS (
  SELECT DISTINCT bd AS d, bl AS l
  FROM c JOIN k x ON x.d = ad AND x.l = al JOIN k y ON y.d = bd AND y.l = bl
  WHERE len(list_intersect(x.s, y.s)) * 100 >= (x.n + y.n - len(list_intersect(x.s, y.s))) * 80
)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM documents
LEFT JOIN (SELECT d, count(*) AS n FROM gone GROUP BY d) r ON r.d = doc_id
LEFT JOIN (SELECT ln.d, string_agg(line, chr(10) ORDER BY ln.l) AS kept
           FROM ln LEFT JOIN gone USING (d, l) WHERE gone.d IS NULL GROUP BY ln.d) t ON t.d = doc_id
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, a bit at a time."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, "
            f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)), "
            "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))")


def _encoded(*values: str) -> str:
    return " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')" for v in values)


MANIFEST_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({_encoded('doc_id', 'source', 'lang', 'n_chars', 'text')}) AS leaf,
         sha256({_encoded('doc_id', 'source', 'lang', 'm', 'text')}) AS now
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN n_chars + 1
                       ELSE n_chars END AS m FROM documents)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM d
), up AS (
  SELECT lang, 0 AS lev, pos, leaf AS node, n FROM p
  UNION ALL
  SELECT lang, lev + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM up WHERE n > 1 GROUP BY lang, lev, pos // 2, n
), g AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lev, pos, subroot AS node, n FROM g
  UNION ALL
  SELECT lev + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM top WHERE n > 1 GROUP BY lev, pos // 2, n
), own AS (
  SELECT p.doc_id, p.lang, p.pos, p.leaf, p.now, up.lev, p.pos >> up.lev AS place, s.node AS sib
  FROM p JOIN up ON up.lang IS NOT DISTINCT FROM p.lang AND up.pos = p.pos >> up.lev AND up.n > 1
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lev = up.lev AND s.pos = xor(p.pos >> up.lev, 1)
), heads AS (
  SELECT g.lang, top.lev, g.pos >> top.lev AS place, s.node AS sib
  FROM g JOIN top ON top.pos = g.pos >> top.lev AND top.n > 1
  LEFT JOIN top s ON s.lev = top.lev AND s.pos = xor(g.pos >> top.lev, 1)
), steps AS (
  SELECT doc_id, lang, pos, row_number() OVER (PARTITION BY lang, pos ORDER BY part, lev) AS k, place, coalesce(sib, '') AS sib
  FROM (SELECT doc_id, lang, pos, 0 AS part, lev, place, sib FROM own
        UNION ALL SELECT p.doc_id, p.lang, p.pos, 1, h.lev, h.place, h.sib
        FROM p JOIN heads h ON h.lang IS NOT DISTINCT FROM p.lang)
), fold AS (
  SELECT lang, pos, 0 AS k, now AS node FROM p
  UNION ALL
  SELECT f.lang, f.pos, f.k + 1, sha256(CASE WHEN s.place % 2 = 0 THEN f.node || s.sib ELSE s.sib || f.node END)
  FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.k = f.k + 1
), ends AS (
  SELECT lang, pos, arg_max(node, k) AS folded_root FROM fold GROUP BY lang, pos
), proofs AS (
  SELECT lang, pos, string_agg(sib, '' ORDER BY k) AS proof FROM steps GROUP BY lang, pos
)
SELECT p.doc_id, p.leaf, g.subroot, r.node AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = r.node AS verified
FROM p JOIN g ON g.lang IS NOT DISTINCT FROM p.lang JOIN top r ON r.n = 1
JOIN ends e ON e.lang IS NOT DISTINCT FROM p.lang AND e.pos = p.pos
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
"""


# A state of reading is a text: cost in nine digits, then the audit ('~': not reached),
# so the least (cost, audit) is the least text.
def _edit(state: str, cost: str, letters: str) -> str:
    return (f"CASE WHEN {state} = '~' THEN '~' ELSE lpad((CAST(substr({state}, 1, 9) AS BIGINT) + {cost})::VARCHAR, 9, '0') "
            f"|| substr({state}, 10) || '{letters}' END")


def _read(states: list[str], initial: str) -> str:
    """The least of reading one turn as ``initial`` from any of the states."""
    return ", ".join(f"CASE WHEN NOT must THEN {_edit(s, '3 + t', 'R')} ELSE '~' END, "
                     f"CASE WHEN NOT must AND c = '{initial}' THEN {_edit(s, 't', 'K')} ELSE '~' END" for s in states)


_CLOSED = (f"s0 AS c0, s1 AS c1, least(s2, {', '.join(_edit(s, '3', 'I') for s in ('s0', 's1', 's3'))}) AS c2, "
           f"least(s3, {_edit('s2', '3', 'I')}, {_edit('s0', '6', 'II')}, {_edit('s1', '6', 'II')}) AS c3")
_SYSTEM = f"CASE WHEN NOT must AND c = 's' THEN {_edit('c0', 't', 'K')} ELSE '~' END"
_CRC = _crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")

CONVERSATIONS_SQL = rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM o WHERE kind <> 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM d
), f AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS c,
         regexp_replace(text, '[ 	-
]+$', '') AS bare,
         k > min(k) OVER (PARTITION BY conv_id, role, text) AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before
  FROM r
), x AS (
  SELECT *, bare = '' AS blank, bare <> '' AND again AS dup,
         bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM f
), n AS (
  SELECT conv_id, k, c, blank OR dup AS must, CASE WHEN cut THEN 3 ELSE 0 END AS t FROM x
), dp AS (
  SELECT conv_id, 0::BIGINT AS k, '000000000' AS s0, '~' AS s1, '~' AS s2, '~' AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, k, {_edit('c0', '4', 'D')}, least({_edit('c1', '4', 'D')}, {_SYSTEM}),
         least({_edit('c2', '4', 'D')}, {_read(['c0', 'c1', 'c3'], 'u')}),
         least({_edit('c3', '4', 'D')}, {_read(['c2'], 'a')})
  FROM (SELECT p.conv_id, n.k, n.c, n.must, n.t, {_CLOSED}
        FROM dp p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.k = p.k + 1)
), best AS (
  SELECT conv_id, least(c0, c3) AS b FROM (
    SELECT conv_id, {_CLOSED} FROM dp QUALIFY k = max(k) OVER (PARTITION BY conv_id))
), audits AS (
  SELECT conv_id, CAST(substr(b, 1, 9) AS BIGINT) AS cost, substr(b, 10) AS audit FROM best
), e AS (
  SELECT conv_id, i, substr(audit, i, 1) AS e, length(replace(audit, 'D', '')) % 2 AS odd
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits)
), w AS (
  SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS k,
         sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS item FROM e
), texts AS (
  SELECT w.conv_id, string_agg(CASE WHEN e = 'K' THEN x.role WHEN (item - 1 - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
                               || ':' || coalesce(x.text, ''), chr(10) ORDER BY i) AS text
  FROM w LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.k = w.k AND w.e <> 'I'
  WHERE e <> 'D' GROUP BY w.conv_id
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM x GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       cost, audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM audits a LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""

SUBSTRING_DEDUP_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS j
  FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY k) AS low FROM win) WHERE low < doc_id
), kept AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS text
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d) ANTI JOIN gone USING (r, j) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
