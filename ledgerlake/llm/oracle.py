"""DuckDB counterparts of the queries that SQL can express on whole tables."""

from __future__ import annotations


def _crc32(value: str) -> str:
    """The CRC-32 of a decimal number, by its public rule: eight steps for each byte."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))"
    codes = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {step}), 4294967295)"


def _merkle(levels: int = 7, key_levels: int = 3) -> str:
    """Levels one by one: ``n`` are the nodes, ``g`` the runs of 8 of them, ``w`` what each row folds so far."""
    part = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(part, ("doc_id", "source", "lang", "n_chars")), part(text)]) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS key, {leaf('text')} AS leaf,
  CASE WHEN {_crc32('doc_id')} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS found FROM documents),
n0 AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, leaf AS h, doc_id, found FROM d),
w0 AS (SELECT key, p, p AS own, h AS leaf, doc_id, found AS f, '' AS proof FROM n0)"""
    for k in range(levels + key_levels):
        if k == levels:  # the subroots are the leaves of the last tree
            sql += f""",
n{k}s AS (SELECT key AS of, '' AS key, row_number() OVER (ORDER BY key) - 1 AS p, h FROM n{k}),
w{k}s AS (SELECT '' AS key, s.p AS p, w.own, w.leaf, w.doc_id, w.f, w.proof, s.h AS subroot FROM w{k} w JOIN n{k}s s ON s.of = w.key)"""
        a, more = ("s", ", w.subroot") if k == levels else ("", ", w.subroot" if k > levels else "")
        sql += f""",
c{k} AS (SELECT key, p, h, count(*) OVER (PARTITION BY key) AS c FROM n{k}{a}),
g{k} AS (SELECT key, p // 8 AS p, c, list(h ORDER BY p) AS run FROM c{k} GROUP BY ALL),
n{k + 1} AS (SELECT key, p, CASE WHEN c > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM g{k}),
w{k + 1} AS (SELECT w.key, w.p // 8 AS p, w.own, w.leaf, w.doc_id,
  CASE WHEN c > 1 THEN sha256(array_to_string(run[:w.p % 8], '') || w.f || array_to_string(run[w.p % 8 + 2:], '')) ELSE w.f END AS f,
  w.proof || CASE WHEN c > 1 THEN array_to_string(run[:w.p % 8], '') || array_to_string(run[w.p % 8 + 2:], '') ELSE '' END AS proof{more}
  FROM w{k}{a} w JOIN g{k} g ON g.key = w.key AND g.p = w.p // 8)"""
    last = levels + key_levels
    return sql + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM w{last} w, n{last}"""


ORACLE: dict[str, str] = {
    "op3_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
        sum(15 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) OVER w AS upto
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR place = turns) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
""",
    "op8_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM d),
k AS (SELECT r, n, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.r, k.n, k.line, c.key IS NOT NULL AS dropped FROM k LEFT JOIN c USING (key)),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '') AS kept FROM m GROUP BY r)
SELECT d.doc_id, g.n_lines, g.n_dropped, sha256(g.kept) AS kept_sha256 FROM d JOIN g USING (r)
""",
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op12_merkle": _merkle(),
    "op13_prefix_trie": f"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32('conv_id')} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN o ON o.conv_id = c.base AND p <= h
      UNION ALL SELECT conv_id, 1, p, role, text FROM o JOIN c USING (conv_id) WHERE p > h),
s AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
        sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS k
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, p ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, depth, k, chars, lag(k, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM s
      UNION ALL SELECT conv_id, 0, '', 0, NULL FROM c),
n AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, any_value(up) AS up FROM m GROUP BY depth, k),
f AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.up = n.k) AS n_children FROM n),
t AS (SELECT m.depth, m.k, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved_tokens
      FROM f JOIN m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.depth, m.k),
l AS (SELECT conv_id, max(depth) AS depth, arg_max(k, depth) AS k FROM m GROUP BY conv_id),
e AS (SELECT depth, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM l GROUP BY depth, k)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM f JOIN t USING (depth, k) LEFT JOIN n p ON p.depth = f.depth - 1 AND p.k = f.up LEFT JOIN e ON e.depth = f.depth AND e.k = f.k
""",
}
