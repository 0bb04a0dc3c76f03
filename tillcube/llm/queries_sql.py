"""SQL that gives the rows of the registered queries, where SQL can: the others learn, encode, or hash in ways that it
has no function for."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

# Levels of a tree of 16 children that the SQL below is written out for: over 16 million leaves.
LEVELS = 6
# CRC-32 of the decimal digits of a document's id.
CRC32 = """xor(list_reduce([4294967295::bigint] || [ascii(c)::bigint for c in string_split(doc_id::varchar, '')],
  lambda crc, byte: list_reduce([xor(crc, byte)] || [0::bigint for x in range(8)],
    lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)), 4294967295)"""


def _tree(name: str) -> str:
    """Levels above ``<name>_0`` (tree, pos, n, digest), and the siblings of every node of each."""
    parts = []
    for level in range(LEVELS):
        node, grown = f"{name}_{level}", f"n > {16**level}"
        run = "over (partition by tree, pos // 16 order by pos rows between"
        parts.append(f"""{name}_siblings_{level} as (select tree, pos, {grown} as grown,
          coalesce(string_agg(digest, '') {run} unbounded preceding and 1 preceding), '') as before,
          coalesce(string_agg(digest, '') {run} 1 following and unbounded following), '') as after from {node})""")
        parts.append(f"""{name}_{level + 1} as (select tree, pos // 16 as pos, n,
          case when {grown} then sha256(string_agg(digest, '' order by pos)) else min(digest) end as digest
          from {node} group by tree, pos // 16, n)""")
    return ", ".join(parts)


def _climbed(leaves: str, name: str) -> str:
    """``leaves`` with their siblings in a tree added to ``proof``, and ``node`` folded with them."""
    for level in range(LEVELS):
        leaves = f"""select l.* exclude (proof, node), case when s.grown then proof || before || after else proof end as proof,
          case when s.grown then sha256(before || node || after) else node end as node
          from ({leaves}) l join {name}_siblings_{level} s on l.tree = s.tree and l.pos // {16**level} = s.pos"""
    return leaves


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen(({x})::varchar) || ':' || ({x})::varchar, '-')" for x in fields) + ")"


def _manifest() -> str:
    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    return f"""with hashed as (select doc_id, coalesce('s' || source, '') as tree, {_leaf("text")} as leaf,
        case when {CRC32} % 5 = 0 then {_leaf(lowered)} else {_leaf("text")} end as altered from documents),
      placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by tree) as n from hashed),
      rows_0 as (select tree, pos, n, leaf as digest from placed), {_tree("rows")},
      groups_0 as (select '' as tree, row_number() over (order by tree) - 1 as pos, count(*) over () as n, digest,
        tree as key from rows_{LEVELS}), {_tree("groups")},
      own as ({_climbed("select *, '' as proof, altered as node from placed", "rows")}),
      topped as (select own.* exclude (tree, pos), g.tree, g.pos, g.digest as subroot
        from own join groups_0 g on own.tree = g.key),
      found as ({_climbed("select * from topped", "groups")})
      select doc_id, leaf, subroot, r.digest as root, sha256(proof) as proof_sha256, node as folded_root,
        node = r.digest as verified from found cross join groups_{LEVELS} r"""


ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": r"""
        select doc_id, min(doc_id) over equal_texts as keep_id, count(*) over equal_texts as group_size,
               doc_id = min(doc_id) over equal_texts as kept, sha256(norm) as text_sha256
        from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
        window equal_texts as (partition by norm)
    """,
    "op13_hard_negatives": """
        with points as (
          select row_number() over () as key, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                 list_transform(embedding, lambda x: floor(256 * cast(x as double))) as vector
          from embeddings
          where label is not null and vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
          select a.key as anchor, a.vec_id as anchor_id, b.key, b.vec_id, a.label = b.label as same,
                 cast(list_inner_product(a.vector, b.vector) as bigint) as score
          from points a join points b on a.vec_id % 50 = 0 and a.key <> b.key),
        positives as (
          select anchor, anchor_id, key as positive, vec_id as positive_id, score as positive_score from scores where same
          qualify row_number() over (partition by anchor order by score desc, vec_id, key) <= 5)
        select anchor_id, positive_id,
               cast(row_number() over (partition by anchor, positive order by score desc, vec_id, key) as integer) as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from positives join scores using (anchor, anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3
    """,
    "op12_merkle_manifest": _manifest(),
}
