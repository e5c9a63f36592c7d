"""Longer pieces of the registered SQL."""

from __future__ import annotations

#: CTE with the 256 remainders of CRC-32 (reflected polynomial 0xEDB88320), made by its rule.
CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS remainders
)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, where ``crc_table`` is in FROM."""
    step = "xor(c >> 8, remainders[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


def _levels(name: str, leaves: str, count: int) -> list[str]:
    """CTEs ``name0``, ``name1``, ...: nodes of each level; a level of one node is the last of its tree."""
    out = [f"{name}0 AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(count):
        run = f"SELECT tree, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k} WHERE n > 1 GROUP BY tree, i // 8"
        out.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({run}))")
    return out


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def merkle_sql(levels: int = 7, top: int = 3) -> str:
    """Manifest, proofs and folds for up to ``8 ** levels`` documents a language and ``8 ** top`` languages."""
    fields = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        CRC_TABLE,
        f"""hashed AS (
            SELECT doc_id, row_number() OVER () AS row, coalesce('=' || lang, '-') AS tree, sha256({fields} || {_field("text")}) AS leaf,
                sha256({fields} || CASE WHEN doc_id IS NOT NULL AND {crc32("coalesce(doc_id, 0)::VARCHAR")} % 3 = 0 THEN {_field(lowered)} ELSE {_field("text")} END) AS claimed
            FROM documents, crc_table)""",
        "docs AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS place FROM hashed)",
        *_levels("l", "(SELECT tree, place AS i, leaf AS h FROM docs)", levels),
        "subroots AS (" + _all([f"SELECT tree, h FROM l{k} WHERE n = 1" for k in range(levels + 1)]) + ")",
        "tops AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, h FROM subroots)",
        *_levels("t", "tops", top),
        "roots AS (" + _all([f"SELECT h AS root FROM t{k} WHERE n = 1" for k in range(top + 1)]) + ")",
        "placed AS (SELECT d.*, s.i AS top_place FROM docs d JOIN tops s ON s.name = d.tree)",
    ]
    steps = [(f"l{k}", "d.tree", "place", k) for k in range(levels)] + [(f"t{k}", "''", "top_place", k) for k in range(top)]
    siblings, before = [], "placed"
    ctes.append("f0 AS (SELECT *, claimed AS f FROM placed)")
    for no, (level, tree, place, k) in enumerate(steps):
        own, run = f"d.{place} // {8**k}", f"d.{place} // {8 ** (k + 1)}"
        joined = f"LEFT JOIN {level} s ON s.tree = {tree} AND s.n > 1 AND s.i // 8 = {run}"
        siblings.append(f"SELECT d.row, {no} AS level, s.i, s.h FROM placed d {joined.removeprefix('LEFT ')} AND s.i <> {own}")
        folded = f"CASE WHEN count(s.i) = 0 THEN any_value(d.f) ELSE sha256(string_agg(CASE WHEN s.i = {own} THEN d.f ELSE s.h END, '' ORDER BY s.i)) END"
        ctes.append(f"f{no + 1} AS (SELECT * EXCLUDE (f, g), g AS f FROM (SELECT d.*, {folded} AS g FROM f{no} d {joined} GROUP BY ALL))")
    ctes.append("proofs AS (SELECT row, string_agg(h, '' ORDER BY level, i) AS proof FROM (" + _all(siblings) + ") GROUP BY row)")
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT d.doc_id, d.leaf, s.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, d.f AS folded_root, d.f = root AS verified
FROM f{len(steps)} d JOIN subroots s USING (tree) CROSS JOIN roots LEFT JOIN proofs USING (row)"""
    )
