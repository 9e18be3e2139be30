"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"

# Measures, exact counts by leading-bits bucket, fences of median and first quartile
# per (lang, source), per lang and over all, each drawn to the wider one and bounded by it.
def quality(min_words: int = 20) -> str:
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, {_WORD}) AS words FROM d),
win AS (
  SELECT rid, u.i AS i, array_to_string(words[u.i:u.i + 7], ' ') AS k
  FROM w, unnest(range(1, len(words) - 6)) AS u(i)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
cover AS (
  SELECT rid, sum(gain) AS n FROM (
    SELECT rid, least(8, i - lag(i, 1, -8) OVER (PARTITION BY rid ORDER BY i)) AS gain FROM twice)
  GROUP BY rid),
line AS (
  SELECT rid, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, {_WORD})] AS ls FROM d),
m AS (
  SELECT d.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM d JOIN w USING (rid) JOIN line USING (rid) LEFT JOIN cover USING (rid)),
r AS (
  SELECT *, n_words < {min_words} OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    [n_symbols * 1000 // greatest(n_words, 1), n_dup_lines * 1000 // greatest(n_lines + 5, 1),
     n_repeat_words * 1000 // greatest(n_words, 1), n_upper * 1000 // greatest(word_chars, 1),
     word_chars * 1000 // greatest(n_words + 10, 1)] AS x
  FROM m),
v AS (
  SELECT lang, source, u.j AS j, x[u.j] AS v, [100, 100, 90, 100, 500][u.j] AS least_range
  FROM r, unnest([1, 2, 3, 4, 5]) AS u(j) WHERE NOT base_failed),
b AS (
  SELECT lang, source, j, least_range,
    (v >> greatest(0, length(bin(v)) - 8)) << greatest(0, length(bin(v)) - 8) AS b FROM v),
f1 AS (SELECT lang, source, j, count(*) AS n,
    quantile_disc(b, 0.5) + 3 * greatest(2 * (quantile_disc(b, 0.5) - quantile_disc(b, 0.25)), any_value(least_range)) AS f
  FROM b GROUP BY lang, source, j),
f2 AS (SELECT lang, j, count(*) AS n,
    quantile_disc(b, 0.5) + 3 * greatest(2 * (quantile_disc(b, 0.5) - quantile_disc(b, 0.25)), any_value(least_range)) AS f
  FROM b GROUP BY lang, j),
f3 AS (SELECT j, quantile_disc(b, 0.5) + 3 * greatest(2 * (quantile_disc(b, 0.5) - quantile_disc(b, 0.25)), any_value(least_range)) AS f
  FROM b GROUP BY j),
g2 AS (SELECT lang, j, least((n * f2.f + 200 * f3.f) // (n + 200), 2 * f3.f) AS f FROM f2 JOIN f3 USING (j)),
g1 AS (
  SELECT f1.lang, f1.source, f1.j, least((n * f1.f + 200 * g2.f) // (n + 200), 2 * g2.f) AS f
  FROM f1 JOIN g2 ON g2.j = f1.j AND g2.lang IS NOT DISTINCT FROM f1.lang),
bad AS (
  SELECT DISTINCT r.rid
  FROM r, unnest([1, 2, 3, 4, 5]) AS u(j)
  JOIN g1 ON g1.j = u.j AND g1.lang IS NOT DISTINCT FROM r.lang AND g1.source IS NOT DISTINCT FROM r.source
  WHERE r.x[u.j] > g1.f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM r
"""


# Every window of 35 words, counted as its own text over the corpus.
SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
win AS (
  SELECT rid, u.i AS i, md5(array_to_string(words[u.i:u.i + 34], ' ')) AS k
  FROM d, unnest(range(1, len(words) - 33)) AS u(i)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT rid, i + o.j AS i FROM twice, unnest(range(0, 35)) AS o(j)),
word AS (SELECT rid, u.i AS i, words[u.i] AS w FROM d, unnest(range(1, len(words) + 1)) AS u(i)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def _licenses() -> str:
    """Units joined to templates whose bigram count is in range; shared bigrams
    are counted as the smaller of both counts."""
    from carelake.llm.license_scan import TEMPLATES

    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(name)}, {quote(text)})" for i, (name, text) in enumerate(TEMPLATES))
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')".format
    return rf"""
WITH tpl AS (SELECT t, license, {words('text')} AS words FROM (VALUES {values}) AS v(t, license, text)),
tgram AS (SELECT t, words[u.i] || ' ' || words[u.i + 1] AS g, count(*) AS c
  FROM tpl, unnest(range(1, len(words))) AS u(i) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
raw AS (
  SELECT rid, text AS unit FROM d
  UNION ALL SELECT rid, unnest(string_split(text, chr(10))) FROM d
  UNION ALL SELECT rid, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) FROM d),
unit AS (
  SELECT row_number() OVER () AS uid, rid, words, len(words) - 1 AS n
  FROM (SELECT DISTINCT rid, {words('unit')} AS words FROM raw) WHERE len(words) > 1),
pair AS (
  SELECT uid, rid, unit.words, unit.n, t, license, len(tpl.words) - 1 AS m
  FROM unit JOIN tpl ON unit.n * 6 >= (len(tpl.words) - 1) * 4 AND unit.n * 4 <= (len(tpl.words) - 1) * 6),
ugram AS (
  SELECT uid, words[u.i] || ' ' || words[u.i + 1] AS g, count(*) AS c
  FROM (SELECT DISTINCT uid, words FROM pair), unnest(range(1, len(words))) AS u(i) GROUP BY ALL),
hit AS (
  SELECT uid, rid, t, license, m, 2.0::DOUBLE * sum(least(ugram.c, tgram.c)) / any_value(n + m) AS score
  FROM pair JOIN ugram USING (uid) JOIN tgram USING (t, g) GROUP BY uid, rid, t, license, m
  HAVING 2.0::DOUBLE * sum(least(ugram.c, tgram.c)) / any_value(n + m) >= 0.8),
best AS (
  SELECT rid, license, score FROM hit
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, m DESC, license DESC) = 1),
al AS (SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_matches FROM hit GROUP BY rid)
SELECT doc_id, best.license, coalesce(score, 0.0::DOUBLE) AS score, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0)::BIGINT AS n_matches
FROM d LEFT JOIN best USING (rid) LEFT JOIN al USING (rid)
"""


# CRC-32 of a short text, byte by byte, with the table of its 256 steps.
_CRC_TABLE = """tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i)))"""


def _crc(text: str) -> str:
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295)"


def _manifest() -> str:
    """Levels of all trees, then of the tree over their roots; siblings are joined
    level by level, and digests folded the same way."""
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(value, ("doc_id", "source", "lang", "n_chars")), value(text)]) + ")"
    grow = """SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3
  FROM {t} WHERE n > 1 GROUP BY tree, lvl, pos // 3, n"""
    fold = """SELECT f.rid, f.tree, f.lvl + 1, f.pos // 3, any_value(f.n + 2) // 3,
    sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.h ELSE s.h END, '' ORDER BY s.pos))
  FROM {f} f JOIN {t} s ON s.tree = f.tree AND s.lvl = f.lvl AND s.pos // 3 = f.pos // 3 WHERE f.n > 1
  GROUP BY f.rid, f.tree, f.lvl, f.pos"""
    return f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS shown
  FROM documents, tab),
src AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree FROM d GROUP BY source),
l AS (SELECT d.*, src.tree, src.n, row_number() OVER (PARTITION BY src.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
up AS (SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM l UNION ALL {grow.format(t="up")}),
sub AS (SELECT tree, h FROM up WHERE n = 1),
crown AS (SELECT 0::BIGINT AS tree, 0 AS lvl, tree AS pos, h, (SELECT count(*) FROM src) AS n FROM sub UNION ALL {grow.format(t="crown")}),
top AS (SELECT h FROM crown WHERE n = 1),
sib AS (
  SELECT rid, 0 AS part, up.lvl, up.pos, up.h FROM l JOIN up ON up.tree = l.tree AND up.n > 1
    AND up.pos // 3 = l.pos // CAST(3 ** (up.lvl + 1) AS BIGINT) AND up.pos <> l.pos // CAST(3 ** up.lvl AS BIGINT)
  UNION ALL
  SELECT rid, 1, c.lvl, c.pos, c.h FROM l JOIN crown c ON c.n > 1
    AND c.pos // 3 = l.tree // CAST(3 ** (c.lvl + 1) AS BIGINT) AND c.pos <> l.tree // CAST(3 ** c.lvl AS BIGINT)),
proof AS (SELECT rid, sha256(string_agg(h, '' ORDER BY part, lvl, pos)) AS p FROM sib GROUP BY rid),
f1 AS (SELECT rid, tree, 0 AS lvl, pos, n, shown AS h FROM l UNION ALL {fold.format(f="f1", t="up")}),
f2 AS (SELECT rid, 0::BIGINT AS tree, 0 AS lvl, tree AS pos, (SELECT count(*) FROM src) AS n, h FROM f1 WHERE n = 1
  UNION ALL {fold.format(f="f2", t="crown")})
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, coalesce(proof.p, sha256('')) AS proof_sha256, f2.h AS folded_root, f2.h = top.h AS verified
FROM l JOIN sub ON sub.tree = l.tree JOIN f2 ON f2.rid = l.rid AND f2.n = 1 CROSS JOIN top LEFT JOIN proof ON proof.rid = l.rid
"""


def _trie() -> str:
    """Every prefix by the digests of its turns; a node's subtree by the names that
    its members have at the node's depth."""
    return f"""
WITH {_CRC_TABLE},
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT DISTINCT c, c - c % 100 AS b, {_crc("CAST(c AS VARCHAR)")} % 6 AS h FROM t, tab),
re AS (
  SELECT conv.c, 0 AS part, t.i, r, x FROM conv JOIN t ON t.c = conv.b AND t.i <= h
  UNION ALL SELECT conv.c, 1, t.i, r, x FROM conv JOIN t ON t.c = conv.c AND t.i > h),
num AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, r, x FROM re),
pre AS (
  SELECT c, d, length(x) AS chars, array_to_string(list(md5(strlen(r) || ':' || r || x)) OVER (PARTITION BY c ORDER BY d), ',') AS k FROM num
  UNION ALL SELECT c, 0, 0, '' FROM conv),
named AS (SELECT c, d, chars, min(c) OVER (PARTITION BY d, k) AS name FROM pre),
node AS (SELECT d, name, count(*) AS n, any_value(chars) AS chars FROM named GROUP BY d, name),
par AS (SELECT node.d, node.name, node.n, (node.n - 1) * node.chars AS own, up.name AS parent
  FROM node LEFT JOIN named up ON up.c = node.name AND up.d = node.d - 1),
kid AS (SELECT d - 1 AS d, parent AS name, count(*) AS kids FROM par WHERE d > 0 GROUP BY ALL),
tot AS (
  SELECT up.d, up.name, count(*) FILTER (kids IS NULL) AS leaves, sum(own) AS saved
  FROM par JOIN named up ON up.c = par.name AND up.d <= par.d LEFT JOIN kid ON kid.d = par.d AND kid.name = par.name
  GROUP BY up.d, up.name),
fin AS (
  SELECT d, name, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT * FROM named QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY d, name)
SELECT par.name AS conv_id, CAST(par.d AS BIGINT) AS depth, par.parent AS parent_conv_id, par.n AS n_convs, coalesce(kids, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM par JOIN tot USING (d, name) LEFT JOIN kid USING (d, name) LEFT JOIN fin USING (d, name)
"""


def _shards() -> str:
    """CRC-32 byte by byte; rows numbered in order; the network's rounds as
    nested tables, walked until a number lands below the row count."""
    from carelake.llm import sharding as S
    from carelake.llm.queries import SHARDS

    rounds = "SELECT origin, step, half, mask, n, x >> half AS l, x & mask AS r FROM walk WHERE step = 0 OR x >= n"
    for k in range(S.ROUNDS):
        t = f"((r + {S.round_key(S.SEED, k)}) % {S.PRIME} * {S.MULTIPLIERS[0]} % {S.PRIME})"
        t = f"(xor({t}, {t} >> 15) % {S.PRIME} * {S.MULTIPLIERS[1]} % {S.PRIME})"
        rounds = f"SELECT origin, step, half, mask, n, r AS l, xor(l, xor({t}, {t} >> 13) & mask) AS r FROM ({rounds})"
    return f"""
WITH RECURSIVE
tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents),
c AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS crc
  FROM d, tab),
s AS (SELECT count(*) AS n, greatest(1, (CASE WHEN count(*) > 1 THEN length(bin(count(*) - 1)) ELSE 0 END + 1) // 2) AS half FROM c),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS number FROM c),
walk AS (
  SELECT number AS origin, 0 AS step, CAST(half AS BIGINT) AS half, (1::BIGINT << half) - 1 AS mask, n, number AS x FROM numbered, s
  UNION ALL
  SELECT origin, step + 1, half, mask, n, (l << half) | r FROM ({rounds})),
place AS (SELECT origin, arg_max(x, step) AS p FROM walk GROUP BY origin)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard,
  CAST(p // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN place ON number = origin
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": _licenses(), "op7_sharding": _shards(), "op8_substring_dedup": SUBSTRINGS, "op10_quality_rules": quality(),
            "op11_merkle_manifest": _manifest(), "op13_conversation_trie": _trie()}
