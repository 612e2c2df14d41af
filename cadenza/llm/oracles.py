"""DuckDB SQL for the queries that SQL can express. The tables of letters here are kept apart from those of the operators, so
that a letter missing there shows."""

from __future__ import annotations

import unicodedata

# Letters that look like a Latin letter, from the lists of confusable characters.
_LATIN_FOR = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ё": "ë", "ї": "ï", "Ё": "Ë", "Ї": "Ï", "ӏ": "l", "օ": "o", "ս": "u", "հ": "h", "Օ": "O",
}
# lower-case letters whose capitals look like Latin ones, for comparisons without case
_LOWER = {"в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "β": "b", "ε": "e", "ζ": "z", "η": "h", "κ": "k", "μ": "m", "τ": "t", "χ": "x"}
_WIDE = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F) if c != 0x27}
_BLANK = {chr(c): " " for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs"} | dict.fromkeys("\t\x0b\x0c", " ")
_GONE = "".join(chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Cf" or 0xFE00 <= c < 0xFE10) + "͏"


def _translate(column: str, pairs: dict[str, str], gone: str = "") -> str:
    return f"translate({column}, '{''.join(pairs) + gone}', '{''.join(pairs.values())}')"


def _skeleton(column: str) -> str:
    """The text with all look-alikes unified into Latin, which compares equal where the consistent forms do. Accents are
    joined first and last, as some only join with the Latin letter."""
    return f"nfc_normalize({_translate(_translate(f'nfc_normalize({column})', _WIDE | _BLANK, _GONE), _LATIN_FOR)})"


def _words(column: str) -> str:
    return f"regexp_extract_all({_translate(f'lower({_skeleton(column)})', _LOWER)}, '[\\p{{L}}\\p{{N}}]+')"


_SPANS = "SELECT utt_id, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e FROM utt_offsets WHERE utt_id IS NOT NULL AND start_time IS NOT NULL AND end_time IS NOT NULL"
_LOOKS = f"m AS (SELECT row_id, text, {_skeleton('text')} AS k FROM manifest WHERE text IS NOT NULL AND regexp_matches(text, '\\S'))"
_GROUPS = f"""k AS (
  SELECT row_id, split, nullif(trim(lower({_skeleton('speaker')})), '') AS s, nullif(trim(lower({_skeleton('id')})), '') AS i FROM manifest),
n AS (SELECT row_id, split, i, coalesce('s:' || coalesce(s, split_part(i, '_', 1)), 'r:' || row_id) AS node FROM k),
e AS (SELECT DISTINCT a.node AS x, b.node AS y FROM n a JOIN n b ON a.i = b.i AND a.node <> b.node),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT node, least(node, coalesce(min(y), node)) AS root FROM (SELECT DISTINCT node FROM n) LEFT JOIN r ON node = x GROUP BY node),
g AS (SELECT row_id, split, min(row_id) OVER (PARTITION BY root) AS group_id, min(coalesce(split, '')) OVER (PARTITION BY root) AS lo, max(coalesce(split, '')) OVER (PARTITION BY root) AS hi
      FROM n JOIN c USING (node))"""
# near copies: pairs of texts that share as many words as they must, and then the edit distance of words row by row
_COPIES = f"""w AS MATERIALIZED (SELECT row_id, split, speaker, {_words('text')} AS w FROM manifest WHERE text IS NOT NULL),
t AS MATERIALIZED (SELECT array_to_string(w, ' ') AS k, split = 'train' AS train, any_value(w) AS w, len(any_value(w)) AS n FROM w WHERE len(w) >= 8 GROUP BY ALL),
o AS (SELECT k, train, n, x, count(*) AS times FROM (SELECT k, train, n, unnest(w) AS x FROM t) GROUP BY ALL),
c AS MATERIALIZED (SELECT a.k AS ka, b.k AS kb FROM o a JOIN o b ON a.x = b.x AND a.train AND NOT b.train AND a.n <= b.n / 0.79 AND b.n <= a.n / 0.79
      GROUP BY a.k, b.k, a.n, b.n HAVING sum(least(a.times, b.times)) >= greatest(a.n, b.n) - floor(greatest(a.n, b.n) * 0.2 + 1e-9)),
p AS MATERIALIZED (SELECT ka, kb, x.w AS a, y.w AS b FROM c JOIN t x ON x.k = ka AND x.train JOIN t y ON y.k = kb AND NOT y.train),
d AS (SELECT ka, kb, list_last(list_reduce(list_transform(a, lambda v: [v]), lambda row, v:
        list_reduce(list_transform(b, lambda z, j: [CASE WHEN z = v[1] THEN '0' ELSE '1' END, CAST(j AS VARCHAR)]), lambda made, q:
          made || [CAST(least(CAST(row[CAST(q[2] AS INT) + 1] AS INT) + 1, CAST(made[CAST(q[2] AS INT)] AS INT) + 1, CAST(row[CAST(q[2] AS INT)] AS INT) + CAST(q[1] AS INT)) AS VARCHAR)],
          [CAST(CAST(row[1] AS INT) + 1 AS VARCHAR)]),
        list_transform(range(0, len(b) + 1), lambda j: CAST(j AS VARCHAR)))) AS edits, greatest(len(a), len(b)) AS longest FROM p),
l AS (SELECT ka, kb FROM d WHERE CAST(edits AS INT) <= floor(longest * 0.2 + 1e-9)),
rows_of AS (SELECT row_id, split, speaker, split = 'train' AS train, array_to_string(w, ' ') AS k FROM w WHERE len(w) >= 8)"""

ORACLES = {
    "p1_found": f"WITH v AS ({_SPANS}) SELECT utt_id FROM v WHERE e > s GROUP BY utt_id HAVING max(e) - min(s) > 30000",
    "p1_checks": f"WITH v AS ({_SPANS}) SELECT utt_id, max(e) - min(s) > 30000 AS oversized, min(s) AS first_ms, max(e) AS last_ms, true AS within_limit, true AS shares_overlap, true AS all_rows FROM v WHERE e > s GROUP BY utt_id",
    "p2_found": f"WITH {_LOOKS} SELECT a.row_id AS row_id_a, b.row_id AS row_id_b FROM m a JOIN m b ON a.k = b.k AND a.row_id < b.row_id AND a.text <> b.text WHERE trim(a.k) <> ''",
    "p2_classes": f"""WITH {_LOOKS}, c AS (SELECT k, min(row_id) AS class_id, count(DISTINCT text) AS spellings, count(*) AS n FROM m WHERE trim(k) <> '' GROUP BY k HAVING count(DISTINCT text) > 1)
SELECT row_id, class_id, spellings, n AS "rows" FROM m JOIN c USING (k)""",
    "p2_looks": f"SELECT row_id, md5({_skeleton('text')}) AS look FROM manifest",
    "p4_found": f"WITH {_COPIES} SELECT least(a.row_id, b.row_id) AS row_id_a, greatest(a.row_id, b.row_id) AS row_id_b FROM l JOIN rows_of a ON a.k = ka AND a.train JOIN rows_of b ON b.k = kb AND NOT b.train",
    "p4_report": f"""WITH {_COPIES}, x AS (SELECT b.row_id, count(*) AS n FROM l JOIN rows_of a ON a.k = ka AND a.train JOIN rows_of b ON b.k = kb AND NOT b.train GROUP BY b.row_id)
SELECT split, speaker, count(*) AS eval_rows, count(n) AS leaked_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs FROM rows_of LEFT JOIN x USING (row_id) WHERE NOT train GROUP BY split, speaker""",
    "p5_found": f"WITH RECURSIVE {_GROUPS} SELECT row_id, group_id FROM g WHERE lo <> hi",
    "p5_checks": f"""WITH RECURSIVE {_GROUPS} SELECT s.split, (SELECT count(*) FROM g) AS n_rows, (SELECT count(DISTINCT group_id) FROM g) AS n_groups, true AS groups_whole,
true AS near_share FROM split_targets s""",
    "p6_found": "SELECT doc_id FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '\\S') AND strlen(text) + 1 > 2048",
    "p6_checks": "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS n_tokens, CAST(strlen(text) AS BIGINT) AS n_bytes, strlen(text) + 1 > 2048 AS divided, true AS fits FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '\\S')",
    "p7_found": f"""
WITH iw AS (SELECT item_id, {_words('text')} AS w FROM eval_items), dw AS (SELECT doc_id, {_words('text')} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM iw)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM dw))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
}
