"""DuckDB SQL for the queries of this subpackage that SQL can express, written
from the contracts alone."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = f"""
WITH p AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path,
         row_number() OVER () AS rid
  FROM p
), rules(rh, rp, act) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT rid, rh || rp AS rule, act, row_number() OVER (PARTITION BY rid ORDER BY length(rh || rp) DESC) AS k
  FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.act, 'allow') AS verdict
FROM h LEFT JOIN m ON m.rid = h.rid AND m.k = 1
"""

#: words of a text by [^\\x20\\x09-\\x0D]+
_SPACE = "[\\x20\\x09-\\x0D]+"

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, [x FOR x IN string_split_regex(text, '{_SPACE}') IF x <> ''] AS ws FROM d),
tok AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
win AS (
  SELECT rid, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS e, lead(word, 4) OVER o AS f
  FROM tok WINDOW o AS (PARTITION BY rid ORDER BY i)
),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, b, c, e, f) AS n FROM win WHERE f IS NOT NULL) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, sum(n - 1) AS n FROM (SELECT rid, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid, line) GROUP BY rid),
c AS (
  SELECT d.rid, doc_id, source, len(w.ws) AS n_words, length(array_to_string(w.ws, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::int) AS bad FROM b GROUP BY source),
prior AS (
  SELECT m, greatest(1.0, least(1e6, m * (1 - m) / greatest(v - m * (1 - m) * inv, 1e-9) - 1)) AS k
  FROM (SELECT sum(bad) / sum(n) AS m, var_pop(bad / n) AS v, avg(1.0 / n) AS inv FROM hosts)
),
ok AS (SELECT source, (bad + m * k) / (n + k) <= 0.5 AS host_ok FROM hosts, prior)
SELECT doc_id, n_words::bigint AS n_words, word_chars::bigint AS word_chars, n_symbols::bigint AS n_symbols,
       n_dup_lines::bigint AS n_dup_lines, n_repeat_words::bigint AS n_repeat_words, base_failed,
       NOT base_failed AND host_ok AS kept
FROM b JOIN ok ON b.source IS NOT DISTINCT FROM ok.source
"""

_ALNUM = "(?:[0-9a-z]|[^\\x00-\\x7F])+"

OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS ws FROM documents),
t AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS ws FROM benchmark),
tw AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[s + 1:s + size], ' ') AS win
  FROM (SELECT *, unnest(range(len(ws) - size + 1)) AS s FROM (SELECT *, least(13, len(ws)) AS size FROM t WHERE len(ws) > 0))
),
sizes AS (SELECT DISTINCT size FROM tw),
dw AS (
  SELECT rid, size, s, array_to_string(ws[s + 1:s + size], ' ') AS win
  FROM (SELECT rid, ws, size, unnest(range(len(ws) - size + 1)) AS s FROM d, sizes WHERE len(ws) >= size)
),
found AS (SELECT rid, s, dw.size AS size, item_id FROM dw JOIN tw ON dw.size = tw.size AND dw.win = tw.win),
hit AS (SELECT rid, count(DISTINCT s + k) AS n FROM (SELECT rid, s, unnest(range(size)) AS k FROM found) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS ids FROM found GROUP BY rid)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(hit.n, 0)::bigint AS n_hit, coalesce(items.n, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

OP5 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '{_SPACE}') IF x <> ''] AS ws FROM documents
),
w AS (
  SELECT rid, s, array_to_string(ws[s + 1:s + 35], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(len(ws) - 34)) AS s FROM d WHERE len(ws) >= 35)
),
twice AS (SELECT rid, s FROM w JOIN (SELECT win FROM w GROUP BY win HAVING count(*) > 1) USING (win)),
gone AS (SELECT DISTINCT rid, s + k AS i FROM (SELECT rid, s, unnest(range(35)) AS k FROM twice)),
lost AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid),
tok AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text FROM tok ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(lost.n, 0)::bigint AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (rid) LEFT JOIN kept USING (rid)
"""

# ---------------------------------------------------------------- checksums and hashes in SQL

def _crc_cell(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, unsigned."""
    table = "[" + ", ".join(f"{_crc_cell(n)}" for n in range(256)) + "]"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ('0x' || p)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)])), 4294967295)"


# The five primes of the 64-bit xxHash.
_PRIME = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
_WRAP = "18446744073709551616::UHUGEINT"


def _wrapped(x: str) -> str:
    return f"(({x}) % {_WRAP})::UBIGINT"


def _times(x: str, y: int) -> str:
    return _wrapped(f"({x})::UHUGEINT * {y}::UHUGEINT")


def _plus(x: str, y: int) -> str:
    return _wrapped(f"({x})::UHUGEINT + {y}::UHUGEINT")


def _rotated(x: str, bits: int) -> str:
    return f"({_times(x, 1 << bits)} | ({x} >> {64 - bits}))"


def _xxhash_steps(table: str, steps: list[tuple[str, str]]) -> str:
    """CTEs that add one column each; the last one is named ``{table}_hashed``."""
    out, was = [], table
    for k, (name, expression) in enumerate(steps):
        now = f"{table}_hashed" if k == len(steps) - 1 else f"{table}_{k}"
        out.append(f"{now} AS (SELECT *, {expression} AS {name} FROM {was})")
        was = now
    return ",\n".join(out)


def _finish(x: str, to: str) -> list[tuple[str, str]]:
    """The hash's last mixing of column ``x``, as ``to``."""
    return [(f"{to}_a", _times(f"xor({x}, {x} >> 33)", _PRIME[1])), (f"{to}_b", _times(f"xor({to}_a, {to}_a >> 29)", _PRIME[2])),
            (to, f"xor({to}_b, {to}_b >> 32)")]


_HASH_LONG = [  # of the long k, with seed 42, as h
    ("h0", _times("(((k::HUGEINT + 18446744073709551616) % 18446744073709551616)::UBIGINT)", _PRIME[1])),
    ("h1", f"xor({(42 + _PRIME[4] + 8) % (1 << 64)}::UBIGINT, {_times(_rotated('h0', 31), _PRIME[0])})"),
    ("h2", _plus(_times(_rotated("h1", 27), _PRIME[0]), _PRIME[3])),
    *_finish("h2", "h"),
]
_HASH_INT = [  # of the int i, with seed h, as g
    ("g0", f"xor({_plus('h', _PRIME[4] + 4)}, {_times('i', _PRIME[0])})"),
    ("g1", _plus(_times(_rotated("g0", 23), _PRIME[1]), _PRIME[2])),
    *_finish("g1", "g"),
]

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, doc_id AS k, octet_length(encode(coalesce(text, ''))) + 8 AS size,
                  {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
{_xxhash_steps("d", _HASH_LONG)},
p AS (SELECT rid, h, s.i FROM d_hashed, range(25) s(i)),
{_xxhash_steps("p", _HASH_INT)},
best AS (SELECT rid, arg_max(i, g >> 11) FILTER (WHERE i < 24) AS shard, arg_max(i, g >> 11) AS grown FROM p_hashed GROUP BY rid)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY CASE WHEN h >= 9223372036854775808 THEN h::HUGEINT - 18446744073709551616 ELSE h::HUGEINT END,
                          doc_id, text_crc32, size) - 1 AS slot,
       grown::INT AS grown_shard
FROM d_hashed JOIN best USING (rid)
"""

OP13 = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL
),
k AS (SELECT c, {_crc32("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (
  SELECT k.c, b.r AS o, b.x FROM k JOIN t b ON b.c = k.c - k.c % 20 AND b.r <= k.h
  UNION ALL SELECT k.c, 3 + t.r, t.x FROM k JOIN t ON t.c = k.c WHERE t.r > k.h
),
seq AS (SELECT k.c, coalesce(list(x ORDER BY o) FILTER (WHERE o IS NOT NULL), []) AS s FROM k LEFT JOIN rebuilt USING (c) GROUP BY k.c),
prefix AS (SELECT c, unnest(range(len(s) + 1)) AS depth, s FROM seq),
node AS (
  SELECT s[1:depth] AS p, depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = depth), '')) AS ends_sha256
  FROM prefix GROUP BY p, depth
),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN node.depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(node.p[node.depth].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM node LEFT JOIN kids ON node.p = kids.p AND node.depth = kids.depth
),
up AS (SELECT p[1:d] AS p, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
       FROM (SELECT p, n_children, saved, unnest(range(depth + 1)) AS d FROM own) GROUP BY ALL)
SELECT own.conv_id, own.depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children, up.n_leaves::BIGINT AS n_leaves,
       up.saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
FROM own JOIN up ON own.p = up.p AND own.depth = up.depth
LEFT JOIN own parent ON parent.p = own.p[1:own.depth - 1] AND parent.depth = own.depth - 1
"""

LLM_ORACLE_SQL = {"op5_substring_dedup": OP5, "op3_decontamination": OP3, "op8_quality_rules": OP8, "op10_url_filter": OP10,
                  "op12_sharding": OP12, "op13_prefix_trie": OP13}
