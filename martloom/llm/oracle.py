"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP3 = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

OP4 = """
WITH t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 100)) AS m
  FROM (SELECT doc_id, unnest(range(0, length(h) // 2 - 49)) AS p, h FROM t) AS at_byte),
g AS (
  SELECT doc_id, p, d0 FROM w JOIN (SELECT m, min(doc_id) AS d0 FROM w GROUP BY m) AS firsts USING (m)),
r AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q
  FROM g WHERE d0 < doc_id),
s AS (
  SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS n
  FROM r),
u AS (
  SELECT doc_id, n, min(p) AS a, max(p) + 50 AS b FROM s GROUP BY doc_id, n),
k AS (
  SELECT doc_id, n, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z,
         row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) AS from_end
  FROM u),
j AS (
  SELECT t.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, CAST(2 * z + 1 AS BIGINT), CAST(2 * (a - z) AS BIGINT)) ||
                    CASE WHEN from_end = 1 THEN substr(h, CAST(2 * b + 1 AS BIGINT)) ELSE '' END, '' ORDER BY a) AS kept
  FROM t JOIN k ON t.doc_id = k.doc_id GROUP BY t.doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM t LEFT JOIN j ON t.doc_id = j.doc_id
"""

OP5 = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM t),
g AS (
  SELECT doc_id, s, row_number() OVER (
    PARTITION BY sha256(array_to_string(list_slice(w, s, s + 19), ' ')) ORDER BY doc_id, s) AS n FROM p),
r AS (
  SELECT DISTINCT doc_id, s + o AS i FROM g, range(0, 20) AS offsets(o) WHERE n > 1),
a AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM t) AS t),
k AS (
  SELECT a.doc_id, count(*) AS kept, string_agg(word, ' ' ORDER BY i) AS words
  FROM a ANTI JOIN r ON a.doc_id = r.doc_id AND a.i = r.i GROUP BY a.doc_id)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(kept, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: bit by bit, as DuckDB has no such function."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"CAST(xor(list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], {codes}), lambda a, b: {byte}), 4294967295) AS BIGINT)"


OP11 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM c),
i AS (
  SELECT conv_id, count(*) AS n, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h, conv_id - conv_id % 20 AS base
  FROM p GROUP BY conv_id),
l AS (
  SELECT i.conv_id, i.h, i.base, least(i.h, coalesce(b.n, 0)) AS lent FROM i LEFT JOIN i AS b ON i.base = b.conv_id),
t AS (
  SELECT l.conv_id, p.pos, role, text FROM l JOIN p ON p.conv_id = l.base AND p.pos <= lent
  UNION ALL
  SELECT l.conv_id, p.pos - (h - lent), role, text FROM l JOIN p ON p.conv_id = l.conv_id WHERE p.pos > h),
k AS (
  SELECT conv_id, string_agg(sha256(strlen(role) || ':' || role || text), '' ORDER BY pos) AS path,
         list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY pos) AS words
  FROM t GROUP BY conv_id),
e AS (
  SELECT conv_id, d, left(path, 64 * d) AS node, len(words) AS n, words[d] AS w
  FROM (SELECT conv_id, coalesce(path, '') AS path, coalesce(words, []) AS words, unnest(range(0, coalesce(len(words), 0) + 1)) AS d
        FROM i LEFT JOIN k USING (conv_id)) AS at_depth),
g AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = d AS leaf, coalesce(any_value(w), 0) AS w,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d) AS ends
  FROM e GROUP BY node, d),
s AS (
  SELECT left(node, CAST(64 * j AS BIGINT)) AS node, j AS d, count(*) FILTER (WHERE d = j + 1) AS n_children,
         count(*) FILTER (WHERE leaf) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM g) AS above GROUP BY 1, 2)
SELECT g.conv_id, g.d AS depth, parent.conv_id AS parent_conv_id, g.n_convs, n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(g.ends, '')) AS ends_sha256
FROM g JOIN s USING (node, d)
LEFT JOIN g AS parent ON parent.d = g.d - 1 AND parent.node = left(g.node, CAST(64 * (g.d - 1) AS BIGINT))
"""


def _edit(best: str, cost: str, letter: str, where: str = "TRUE") -> str:
    """A cost of nine digits and the audit, so that the least text is the cheapest and first one."""
    added = f"lpad(CAST(CAST(left({best}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({best}, 10) || '{letter}'"
    return f"CASE WHEN {where} THEN {added} END"


def _shifted(role: str, before: list[str]) -> str:
    ways = [_edit(b, "more", "K", f"sound AND initial = '{role}'") for b in before]
    ways += [_edit(b, "3 + more", "R", "sound") for b in before if role != "s"]
    return ", ".join(ways)


# States of the grammar: nothing so far (z), after the system's turn (s), a user's (u), an assistant's (a).
OP12 = rf"""
WITH RECURSIVE o AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS key, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
f AS (
  SELECT *, {_crc32("name")} % 20 AS fate FROM o),
d AS (
  SELECT key, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM f WHERE fate <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d),
m AS (
  SELECT key, turn, i, role, text, left(role, 1) AS initial,
         CASE WHEN body = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(lag(role) OVER (PARTITION BY key ORDER BY i), 1) AS before
  FROM n),
b AS (
  SELECT key, i, initial, fault IN ('', 'truncated') AS sound, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM m),
walk AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT) AS i, '000000000' AS z, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
         CAST(NULL AS VARCHAR) AS a
  FROM b
  UNION ALL
  SELECT key, b.i, {_edit("z", "4", "D")}, least({_edit("s", "4", "D")}, {_shifted("s", ["z"])}),
         least({_edit("u", "4", "D")}, {_shifted("u", ["z", "s", "a"])}), least({_edit("a", "4", "D")}, {_shifted("a", ["u"])})
  FROM (
    SELECT key, i, z, s, u, least(a, {_edit("u", "3", "I")}) AS a
    FROM (SELECT key, i, z, s, a,
                 least(u, {_edit("z", "3", "I")}, {_edit("s", "3", "I")}, {_edit("a", "3", "I")}) AS u FROM walk) AS w1) AS w
  JOIN b USING (key) WHERE b.i = w.i + 1),
done AS (
  SELECT key, least(z, a, {_edit("u", "3", "I")}, {_edit(_edit("s", "3", "I"), "3", "I")}) AS best
  FROM walk QUALIFY i = max(i) OVER (PARTITION BY key)),
ops AS (
  SELECT key, op, k, count(*) FILTER (WHERE op <> 'I') OVER w AS i, count(*) FILTER (WHERE op <> 'D') OVER w AS nth
  FROM (SELECT key, unnest(string_split(substr(best, 10), '')) AS op, generate_subscripts(string_split(substr(best, 10), ''), 1) AS k
        FROM done) AS listed
  WHERE op <> '' WINDOW w AS (PARTITION BY key ORDER BY k)),
kept AS (
  SELECT ops.key, k, nth, op, m.role, m.text,
         max(CASE WHEN nth = 1 AND op = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY ops.key) AS led
  FROM ops LEFT JOIN m ON ops.key = m.key AND ops.i = m.i WHERE op <> 'D'),
lines AS (
  SELECT key, string_agg(CASE WHEN op = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                         CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS said
  FROM kept GROUP BY key),
counts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM m GROUP BY key)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(left(best, 9), '0') AS BIGINT) AS cost,
       coalesce(substr(best, 10), '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT key, conv_id FROM o) AS known
LEFT JOIN counts USING (key) LEFT JOIN done USING (key) LEFT JOIN lines USING (key)
"""


def statements() -> dict[str, str]:
    return {
        "op3_exact_dedup": OP3,
        "op4_suffix_dedup": OP4,
        "op5_substring_dedup": OP5,
        "op11_prefix_trie": OP11,
        "op12_structure_repair": OP12,
    }
