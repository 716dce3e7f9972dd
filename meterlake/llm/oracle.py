"""DuckDB twins of the operators that SQL can express, written from their definitions rather than from their methods."""

from __future__ import annotations

# CRC-32 (reflected polynomial 0xEDB88320) of the decimal digits of conv_id
CRC32_OF_ID = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
             lambda x: ascii(x)::BIGINT)), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda y, i: xor(y >> 1, (y & 1) * 3988292384 + i))), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH t AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (
    SELECT conv_id, count(*) AS n, any_value({CRC32_OF_ID}) % 9 AS h, any_value(conv_id - conv_id % 5) AS base
    FROM t GROUP BY conv_id),
r AS (
    SELECT c.conv_id, t.pos AS depth, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
    FROM c JOIN t ON t.conv_id = c.conv_id LEFT JOIN c b ON b.conv_id = c.base WHERE t.pos > c.h),
s AS (
    SELECT c.conv_id, coalesce(any_value(q.seq), []) AS seq
    FROM c LEFT JOIN (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY depth) AS seq FROM r GROUP BY conv_id) q
    USING (conv_id) GROUP BY c.conv_id),
p AS MATERIALIZED (
    SELECT conv_id, d, len(seq) = d AS ends, to_json(seq[1:d])::VARCHAR AS node,
           CASE WHEN d > 0 THEN to_json(seq[1:d - 1])::VARCHAR END AS parent,
           CASE WHEN d > 0 THEN strlen(seq[d].text) ELSE 0 END AS bytes
    FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS MATERIALIZED (
    SELECT node, any_value(d) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(bytes) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM p GROUP BY node),
k AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
b AS (
    SELECT p.node, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
    FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.depth LEFT JOIN k ON k.parent = n.node GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN b USING (node) LEFT JOIN k ON k.parent = n.node LEFT JOIN n up ON up.node = n.parent
"""


def assigned(book: str, name: str) -> str:
    """Nearest entry of every part by comparing it with all entries of its position."""
    return f"""
{name} AS MATERIALIZED (
    SELECT rid, part, first(v) AS v, arg_min(entry, (gap, entry)) AS entry, min(gap) AS gap FROM (
        SELECT x.rid, x.part, x.v, e.entry, (list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, e.v)
               + list_inner_product(e.v, e.v))::BIGINT AS gap
        FROM x JOIN {book} e ON e.part = x.part) GROUP BY rid, part)"""


def averaged(book: str, given: str, name: str) -> str:
    """Every entry's parts averaged component by component, rounded down; unused entries stay."""
    return f"""
{name} AS MATERIALIZED (
    SELECT e.part, e.entry, coalesce(any_value(m.v), any_value(e.v)) AS v FROM {book} e LEFT JOIN (
        SELECT part, entry, list(floor_mean ORDER BY pos) AS v FROM (
            SELECT part, entry, pos, ((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*))::DOUBLE AS floor_mean
            FROM (SELECT part, entry, unnest(v)::BIGINT AS c, generate_subscripts(v, 1) AS pos FROM {given})
            GROUP BY part, entry, pos) GROUP BY part, entry) m ON m.part = e.part AND m.entry = e.entry
    GROUP BY e.part, e.entry)"""


PRODUCT_CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
    SELECT rid, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v
    FROM (SELECT rid, v, unnest(range(4)) AS part FROM kept)),
b0 AS MATERIALIZED (
    SELECT x.part, f.entry, x.v FROM x JOIN (
        SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept) f USING (rid) WHERE f.entry < 256),
{",".join(assigned(f"b{i}", f"a{i}") + "," + averaged(f"b{i}", f"a{i}", f"b{i + 1}") for i in range(4))},
{assigned("b4", "a4")},
hash AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
         FROM (SELECT part, entry, unnest(v) AS c, generate_subscripts(v, 1) AS pos FROM b4)),
done AS (SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(gap)::BIGINT AS error
         FROM a4 GROUP BY rid)
SELECT k.vec_id, d.code, d.error, sum(d.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, hash.codebooks_sha256
FROM done d JOIN kept k USING (rid), hash
"""

ORACLE: dict[str, str] = {"op12_orchard_product_codes": PRODUCT_CODES, "op13_collapsed_prefix_trie": PREFIX_TRIE}
