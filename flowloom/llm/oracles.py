"""The SQL that gives what the queries return, where SQL can express them."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from flowloom.llm import rules

_WORD = r"[^\x20\x09-\x0D]+"

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{_WORD}') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: words[i:i + 3])) END AS grams FROM w),
s AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS other FROM sets UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT sets.doc_id, len(grams)::BIGINT AS n_shingles, min(other) AS component_id
FROM sets JOIN reach ON node = sets.doc_id GROUP BY sets.doc_id, grams
"""


def _levels() -> str:
    """The fence of a row: its group's, its language's or the corpus's, by the documents that these hold."""
    kept = []
    for m in rules.MEASURES:
        tests = [f"({m} >= {lv}.{m}_lo AND {m} <= {lv}.{m}_hi)" for lv in ("f0", "f1", "f2")]
        kept.append(
            f"coalesce(CASE WHEN f0.n_rows >= {rules.LEAST_ROWS} THEN {tests[0]} WHEN f1.n_rows >= {rules.LEAST_ROWS} THEN {tests[1]} ELSE {tests[2]} END, true)"
        )
    return " AND ".join(kept)


def _fences(name: str, keys: list[str]) -> str:
    by, group = ", ".join([*keys, "measure"]), f"GROUP BY {', '.join(keys)}" if keys else ""
    slack = " ".join(f"WHEN '{m}' THEN {v}" for m, v in rules.MEASURES.items())
    columns = ", ".join(f"max(CASE WHEN measure = '{m}' THEN {x} END) AS {m}_{x}" for m in rules.MEASURES for x in ("lo", "hi"))
    lead = "".join(f"{k}, " for k in keys)
    return f"""{name} AS (
  SELECT {lead}max(n_rows) AS n_rows, {columns} FROM (
    SELECT {lead}measure, n_rows, q1 - reach AS lo, q3 + reach AS hi FROM (
      SELECT *, greatest({rules.REACH} * (q3 - q1), CASE measure {slack} END) AS reach FROM (
        SELECT {lead}measure, max(n_rows) AS n_rows, min(bucket) FILTER (WHERE 4 * upto >= n_rows) AS q1, min(bucket) FILTER (WHERE 4 * upto >= 3 * n_rows) AS q3
        FROM (SELECT {lead}measure, bucket, sum(sum(n)) OVER (PARTITION BY {by} ORDER BY bucket) AS upto, sum(sum(n)) OVER (PARTITION BY {by}) AS n_rows
              FROM sketch GROUP BY {by}, bucket) GROUP BY {by}))) {group})"""


QUALITY = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) > 2),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, words[i:i + 2]) > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(lines) AS n_lines, length(regexp_replace(text, '[^!?]', '', 'g')) AS n_shouts, coalesce(repeated.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (doc_id)),
m AS (
  SELECT *, coalesce(1000 * word_chars // nullif(n_words, 0), 0) AS mean_word, coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS symbols,
    coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_lines, coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeats,
    coalesce(1000 * n_shouts // nullif(n_words, 0), 0) AS shouts, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
long AS (UNPIVOT (SELECT lang, source, {', '.join(f'{m}::BIGINT AS {m}' for m in rules.MEASURES)} FROM m WHERE NOT base_failed)
  ON {', '.join(rules.MEASURES)} INTO NAME measure VALUE v),
sketch AS (
  SELECT lang, source, measure, (v >> greatest(length(bin(v)) - {rules.BITS}, 0)) << greatest(length(bin(v)) - {rules.BITS}, 0) AS bucket, count(*) AS n
  FROM long GROUP BY ALL),
{_fences('g0', ['lang', 'source'])},
{_fences('g1', ['lang'])},
{_fences('g2', [])}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_levels()} AS kept
FROM m LEFT JOIN g0 f0 ON f0.lang IS NOT DISTINCT FROM m.lang AND f0.source IS NOT DISTINCT FROM m.source
LEFT JOIN g1 f1 ON f1.lang IS NOT DISTINCT FROM m.lang LEFT JOIN g2 f2 ON true
"""

_LEAF = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars")
)
_LEAF_TEXT = "CASE WHEN {t} IS NULL THEN '-' ELSE octet_length(encode({t})) || ':' || {t} END"


def _levels(name: str, source: str) -> str:
    """Nodes of all levels of the trees over ``source`` (grp, idx, h, n), and each one's siblings in its run."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, idx, h, n FROM {source}
  UNION ALL SELECT grp, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 3, n),
{name}_by AS (
  SELECT a.grp, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM {name} a JOIN {name} b ON a.grp = b.grp AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.grp, a.lvl, a.idx)"""


# CRC-32 by its definition: eight shifts for each byte of the decimal id.
MANIFEST = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, 0 AS k, 4294967295::BIGINT AS v FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, k + 1, xor(w // 2, CASE WHEN w % 2 = 1 THEN 3988292384 ELSE 0 END) FROM (
    SELECT doc_id, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(doc_id::VARCHAR, k // 8 + 1, 1))::BIGINT) ELSE v END AS w
    FROM crc WHERE k < 8 * length(doc_id::VARCHAR)) x),
even AS (SELECT doc_id, v % 2 = 1 AS even FROM crc WHERE k = 8 * length(doc_id::VARCHAR)),
d AS (
  SELECT doc_id, coalesce('v' || source, 'n') AS grp, sha256({_LEAF} || {_LEAF_TEXT.format(t='text')}) AS leaf,
         CASE WHEN even THEN sha256({_LEAF} || {_LEAF_TEXT.format(t="replace(text, chr(10), '')")}) END AS changed
  FROM documents LEFT JOIN even USING (doc_id)),
leaves AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM d),
{_levels('own', 'leaves')},
subs AS (SELECT grp AS name, h AS subroot FROM own WHERE n = 1),
tops AS (SELECT '' AS grp, name, subroot AS h, row_number() OVER (ORDER BY name) - 1 AS idx, count(*) OVER () AS n FROM subs),
{_levels('upper', 'tops')},
climb AS (
  SELECT grp, idx AS row, idx, 0 AS lvl, coalesce(changed, leaf) AS h, '' AS proof FROM leaves
  UNION ALL SELECT c.grp, c.row, c.idx // 3, c.lvl + 1, sha256(b.l || c.h || b.r), c.proof || b.l || b.r
  FROM climb c JOIN own_by b ON b.grp = c.grp AND b.lvl = c.lvl AND b.idx = c.idx),
reached AS (SELECT grp, row, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM climb GROUP BY grp, row),
rest AS (
  SELECT r.grp, r.row, t.idx, 0 AS lvl, r.h, r.proof FROM reached r JOIN tops t ON t.name = r.grp
  UNION ALL SELECT c.grp, c.row, c.idx // 3, c.lvl + 1, sha256(b.l || c.h || b.r), c.proof || b.l || b.r
  FROM rest c JOIN upper_by b ON b.lvl = c.lvl AND b.idx = c.idx),
ended AS (SELECT grp, row, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM rest GROUP BY grp, row)
SELECT l.doc_id, l.leaf, s.subroot, u.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = u.h AS verified
FROM leaves l JOIN ended e ON e.grp = l.grp AND e.row = l.idx JOIN subs s ON s.name = l.grp, upper u WHERE u.n = 1
"""
