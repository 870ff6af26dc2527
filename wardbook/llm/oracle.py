"""DuckDB SQL that the queries have to agree with, where SQL can express them."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _framed(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


_OWN = " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars"))


def _levels(name: str, leaves: str) -> str:
    """A tree's levels, and every node with the siblings before and after it."""
    others = "string_agg(digest, '') OVER (PARTITION BY tree, h, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""
{name}(tree, h, pos, digest, n) AS (
    SELECT tree, 0, pos, digest, n FROM {leaves}
    UNION ALL
    SELECT tree, h + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
    FROM {name} WHERE n > 1 GROUP BY tree, h, n, pos // 8
),
{name}_kin AS (
    SELECT tree, h, pos,
        coalesce({others} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce({others} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name} WHERE n > 1
)"""


def _climb(name: str, start: str, kin: str) -> str:
    """From each row of ``start`` to the top of its tree."""
    return f"""
{name}(rid, tree, h, pos, fold, siblings) AS (
    SELECT rid, tree, 0, pos, fold, siblings FROM {start}
    UNION ALL
    SELECT c.rid, c.tree, c.h + 1, c.pos // 8, sha256(k.before || c.fold || k.after), c.siblings || k.before || k.after
    FROM {name} c JOIN {kin} k ON k.tree = c.tree AND k.h = c.h AND k.pos = c.pos
),
{name}_top AS (SELECT rid, arg_max(fold, h) AS fold, arg_max(siblings, h) AS siblings FROM {name} GROUP BY rid)"""


MERKLE = f"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
hit AS (
    SELECT row_number() OVER () AS rid, d.*,
        xor(list_reduce(
            list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
        ), 4294967295) % 3 = 0 AS changed
    FROM documents d, crc
),
leaf AS (
    SELECT rid, doc_id, coalesce('=' || lang, '-') AS tree,
        sha256({_OWN} || {_framed("text")}) AS digest,
        sha256({_OWN} || CASE WHEN changed THEN {_framed(f"translate(text, {_AZ})")} ELSE {_framed("text")} END) AS found
    FROM hit
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, rid) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n
    FROM leaf
),
{_levels("low", "placed")},
subroots AS (
    SELECT tree AS lang, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
    FROM low WHERE n = 1
),
{_levels("high", "subroots")},
root AS (SELECT digest AS root FROM high WHERE n = 1),
begin_low AS (SELECT rid, tree, pos, found AS fold, '' AS siblings FROM placed),
{_climb("up_low", "begin_low", "low_kin")},
begin_high AS (
    SELECT p.rid, '' AS tree, s.pos, t.fold, t.siblings
    FROM placed p JOIN up_low_top t USING (rid) JOIN subroots s ON s.lang = p.tree
),
{_climb("up_high", "begin_high", "high_kin")}
SELECT p.doc_id, p.digest AS leaf, s.digest AS subroot, root, sha256(t.siblings) AS proof_sha256,
    t.fold AS folded_root, t.fold = root AS verified
FROM placed p JOIN subroots s ON s.lang = p.tree JOIN up_high_top t USING (rid), root
"""

# Bytes beyond ASCII belong to no class below, so they are part of terms.
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
WITH read AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS found FROM documents),
docs AS (SELECT rid, doc_id, found, len(found) AS n FROM read WHERE len(found) > 0),
size AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM docs),
held AS (
    SELECT rid, doc_id, n, term, count(*) AS tf
    FROM (SELECT rid, doc_id, n, unnest(found) AS term FROM docs) GROUP BY ALL
),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, size GROUP BY term
),
asked AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (
        SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
),
scored AS (
    SELECT item, item_id, rid, doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM asked JOIN weight USING (term) JOIN held USING (term), size
    GROUP BY item, item_id, rid, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
