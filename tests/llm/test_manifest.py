"""The Merkle manifest against trees built in plain Python."""

import hashlib
import zlib
from string import ascii_lowercase, ascii_uppercase

import odd
import pytest
from pyspark.sql import functions as F

from tillcube.llm import manifest
from tillcube.llm.queries import QUERIES

NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, tree string, nodes long, item string"
LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if value is None else f"{len(str(value).encode())}:{value}" for value in values))


def grown(nodes, width):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[at : at + width])) for at in range(0, len(below), width)])
    return levels


def path(levels, at, width):
    found = []
    for nodes in levels[:-1]:
        first = at // width * width
        found.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + width])))
        at //= width
    return found


def proved(rows, width=16):
    """Rows of (doc_id, source, lang, n_chars, text) to rows of the query."""
    groups = {}
    for row in rows:
        doc_id, text = row[0], row[4]
        altered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        changed = leaf([*row[:4], text if text is None else text.translate(LOWER)]) if altered else leaf(row[:5])
        groups.setdefault(row[1], []).append((doc_id is not None, doc_id or 0, leaf(row[:5]), changed))
    keys = sorted(groups, key=lambda key: (key is not None, (key or "").encode()))
    trees = {key: grown([x[2] for x in sorted(groups[key])], width) for key in keys}
    top = grown([trees[key][-1][0] for key in keys], width)
    for place, key in enumerate(keys):
        for at, (known, doc_id, own, node) in enumerate(sorted(groups[key])):
            siblings = path(trees[key], at, width) + path(top, place, width)
            for before, after in siblings:
                node = sha(before + node + after)
            digest = sha("".join(before + after for before, after in siblings))
            yield doc_id if known else None, own, trees[key][-1][0], top[-1][0], digest, node, node == top[-1][0]


def result(df):
    return odd.many(tuple(row[name] for name in NAMES) for row in df.collect())


def test_odd_rows(spark, odd_folder):
    rows = [(row[0], row[3], row[2], row[4], row[1]) for row in odd.rows()]
    assert result(QUERIES["op12_merkle_manifest"](spark, odd_folder)) == odd.many(proved(rows))


@pytest.fixture(scope="module")
def many_rows(spark, tmp_path_factory):
    """A source of more rows than two written levels hold, many small ones, some without a name; ids that repeat."""
    rows = [(at, "large", "en", at, f"Text {at}") for at in range(4500)]
    rows += [(at % 40, f"small {at % 300}é" if at % 7 else None, None, None, "A" * (at % 5) or None) for at in range(900)]
    rows += [(None, "large", "x", 1, "No id"), (3, "large", "en", 3, "Text 3"), (3, "large", "en", 3, "Other")]
    folder = str(tmp_path_factory.mktemp("manifest"))
    table = spark.createDataFrame([(*row, "t", 1, "i") for row in rows], COLUMNS)
    table.repartition(6, F.xxhash64("text")).write.parquet(f"{folder}/documents.parquet")
    return rows, folder


def test_deep_trees_and_many_sources(spark, many_rows):
    rows, folder = many_rows
    assert result(QUERIES["op12_merkle_manifest"](spark, folder)) == odd.many(proved(rows))


@pytest.mark.parametrize("width, every", [(2, 3), (3, 1), (16, 1), (5, 4)])
def test_levels_between_are_worked_out_again(spark, many_rows, width, every):
    rows, folder = many_rows
    built = manifest.build(spark.read.parquet(f"{folder}/documents.parquet"), width=width, every=every)
    depth = 1
    while width ** (every * depth) < 4503:
        depth += 1
    assert len(built.rows.levels) == depth
    found = manifest.proofs(built)
    expected = odd.many((x[0], x[1], x[2], x[3], x[4]) for x in proved(rows, width))
    digest = manifest.proof_digest(F.col("siblings")).alias("proof")
    assert odd.many(tuple(x) for x in found.select("doc_id", "leaf", "subroot", "root", digest).collect()) == expected
    assert found.where(manifest.folded(F.col("leaf"), F.col("siblings")) != F.col("root")).isEmpty()
    assert built.root.first().root == next(proved(rows, width))[3]


def test_a_value_cannot_pass_for_another(spark):
    docs = spark.createDataFrame([(1, "-", None, 1, "1:1"), (1, None, "-", 1, "1:1")], COLUMNS.rsplit(",", 3)[0])
    leaves = [row.leaf for row in docs.select(manifest.leaf(*[F.col(x) for x in manifest.FIELDS]).alias("leaf")).collect()]
    assert len(set(leaves)) == 2
