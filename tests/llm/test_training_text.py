"""Operators beyond their queries: own parameters, texts and files that come out, the pipeline."""

import random
from pathlib import Path

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillcube.llm import (
    exact_dedup,
    piece_viterbi,
    quality_classifier,
    sharding,
    simhash_dedup,
    token_counts,
    token_files,
)
from tillcube.llm.bk_forest import Forest, lowest_linked
from tillcube.llm.components import stars
from tillcube.llm.segments import SegmentEncoder
from tillcube.llm.tables import documents, labels
from tillcube.llm.tokens import tokenizer_path


@pytest.mark.parametrize("name, blank", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_segments_give_the_ids_of_whole_texts(name, blank):
    import pyarrow as pa

    draw = random.Random(1)
    signs = ["a", "b ", " ", "\n", "'s", "1", "é", "!", "<|endoftext|>", "\xa0", "中", "  ", "\t", "́", "A", ". ", ", c", "word.\nNext"]
    found = odd.texts() + ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(1500)]
    plain = Tokenizer.from_file(tokenizer_path(name))
    encoder = SegmentEncoder(tokenizer_path(name), blank, remembered=300)
    for _ in range(2):
        ids, begin = encoder.encode(pa.array(found, pa.string()))
        for at, text in enumerate(found):
            assert ids[begin[at] : begin[at + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(400, 40), (1500, 300)])
def test_huge_texts_are_spliced(spark, chunk, overlap):
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    draw = random.Random(chunk)
    signs = ["a", " b", "  ", "\n", "'s", "12", "é", "!!", "<|endoftext|>", "中", " word", "\t"]
    found = [*odd.texts(), "z" * 5000, " " * 2500 + "end", "<|endoftext|>" * 300, "ab" * 900 + " " + "!" * 1100]
    found += ["".join(draw.choice(signs) for _ in range(3000)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    counted = {row.doc_id: row.n_tokens for row in token_counts.counts(docs, chunk=chunk, overlap=overlap).collect()}
    for at, text in enumerate(found):
        assert counted[at] == len(plain.encode(text or "", add_special_tokens=False).ids)


def test_one_long_text_is_encoded_by_several_tasks(spark):
    text = " ".join([odd.prose(1, 20_000)] * 120)
    assert len(text) > 10_000_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = docs.select("doc_id", F.lit(0).cast("long").alias("row_key"), F.lit(0).cast("long").alias("n_bytes"), "text")
    cut = token_counts.chunks(rows, token_counts.CHUNK, token_counts.OVERLAP)
    spread = cut.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and sum(row["count"] for row in spread) == -(-(len(text) - 512) // (65_536 - 512))
    again = sorted(cut.collect())
    assert all(row.text == text[row["at"] : row["at"] + token_counts.CHUNK] for row in again)
    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    counted = token_counts.counts(docs).first()
    assert (counted.n_bytes, counted.n_tokens) == (len(text.encode()), len(plain.encode(text, add_special_tokens=False).ids))


def test_trees_find_what_comparing_all_finds():
    draw = np.random.default_rng(2)
    prints = np.unique(draw.integers(0, 2**63, 12).repeat(40) ^ (1 << draw.integers(0, 62, 480)) ^ (1 << draw.integers(0, 62, 480)))
    prints = prints.astype(np.uint64)
    tree = np.sort(draw.integers(0, 3, len(prints)))
    pairs = {pair for a, b in Forest(prints, tree).within(2) for pair in zip(a.tolist(), b.tolist(), strict=True)}
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 2
    near &= (tree[:, None] == tree[None]) & ~np.eye(len(prints), dtype=bool)
    assert pairs == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    assert lowest_linked(5, [(np.array([3, 4]), np.array([1, 3]))]).tolist() == [0, 1, 2, 1, 1]


def test_components_of_chains_and_stars(spark):
    chain = [(at + 1, at) for at in range(40)]
    star = [(100 + at, 100) for at in range(1, 50)]
    found = stars(spark.createDataFrame([*chain, *star, (200, 199), (201, 200), (201, 199)], "node long, other long"))
    roots = {row.node: row.root for row in found.collect()}
    expected = {at: 0 for at in range(1, 41)} | {100 + at: 100 for at in range(1, 50)} | {200: 199, 201: 199}
    assert roots == expected


@pytest.mark.parametrize("operator", [exact_dedup.deduplicate, simhash_dedup.deduplicate])
def test_copies_leave_one_with_all_its_columns(spark, odd_folder, operator):
    docs = documents(spark, odd_folder)
    kept = operator(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    marks = exact_dedup.marks(docs)
    assert {row.keep_id for row in marks.collect()} >= set(ids) - {None}
    if operator is exact_dedup.deduplicate:
        assert odd.many(ids) == odd.many(row.doc_id for row in marks.where("kept").collect())


def test_a_large_group_of_copies_is_cut_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "the  same").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup.marks(docs)
    kept = exact_dedup.deduplicate(docs)
    assert found.where("keep_id = 1 and group_size = 4000").count() == 4000
    assert found.where("kept").count() == kept.count() == 2001
    assert kept.where("text = 'the  same'").first().doc_id == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_shards_and_token_files_are_written(spark, odd_folder, folder):
    docs = documents(spark, odd_folder)
    sharding.write_shards(docs, f"{folder}/shards", 3)
    written = spark.read.parquet(f"{folder}/shards")
    assert written.count() == docs.count() and written.where("text is null").count() == 1
    assert {row.shard for row in written.select("shard").collect()} <= {0, 1, 2}
    token_files.write(docs, f"{folder}/tokens")
    metadata = token_files.read_metadata(spark, f"{folder}/tokens")
    assert metadata.count() == docs.count()
    some = token_files.read_documents(spark, f"{folder}/tokens", [13, 16])
    assert "In(doc_id, [13,16])" in some._jdf.queryExecution().executedPlan().toString()
    assert {row.doc_id: len(row.ids) for row in some.collect()} == {
        row.doc_id: row.n_tokens for row in metadata.where("doc_id in (13, 16)").collect()
    }


def test_pieces_decode_to_the_text(spark, odd_folder):
    docs = documents(spark, odd_folder)
    decoded = piece_viterbi.decode(piece_viterbi.encode(docs))
    plain = docs.select("doc_id", F.translate(F.coalesce("text", F.lit("")), "▁", " ").alias("text"))
    assert decoded.exceptAll(plain).isEmpty() and plain.exceptAll(decoded).isEmpty()
    missing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert piece_viterbi.decode(missing).first().text is None


def test_classifier_on_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.01"
    scored = quality_classifier.scored(documents(spark, folder), labels(spark, folder))
    seen = scored.join(labels(spark, folder), "doc_id").where("held_out").collect()
    low = [row.score for row in seen if row.quality == 0]
    high = [row.score for row in seen if row.quality == 1]
    ranked = sum((a > b) + (a == b) / 2 for a in high for b in low) / (len(high) * len(low))
    assert ranked > 0.95 and sum(row.predicted == row.quality for row in seen) > 0.93 * len(seen)


def test_pipeline(spark, small, odd_folder):
    docs = documents(spark, small)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.materialize(stage(spark, docs, small), name)
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).isEmpty()
        docs = kept
    known = labels(spark, small)
    good = documents(spark, small).join(known.where("quality = 1"), "doc_id").count()
    assert docs.join(known.where("quality = 1"), "doc_id").count() > 0.75 * good
    assert docs.join(known.where("quality = 0"), "doc_id").count() <= 1
    assert exact_dedup.marks(docs).where("not kept").isEmpty()
    packed = corpus_pipeline.run(spark, odd_folder)
    assert packed.where("offset + length > 1024").isEmpty()


def test_pipeline_of_no_documents(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).collect() == []


def test_token_files_are_laid_out_for_selective_reads(spark, folder):
    """Encodings, row groups and page indexes as the written files have them."""
    import pyarrow.parquet as pq

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(1), F.lit(40)), lambda x: F.concat(F.lit("w"), (x * F.col("id") % 97).cast("string")))).alias("text"))
    token_files.write(docs.coalesce(1), f"{folder}/tokens", options=token_files.write_options(1 << 15, 1 << 12))
    files = [pq.ParquetFile(path) for path in sorted(Path(f"{folder}/tokens").glob("*.parquet"))]
    groups = [file.metadata.row_group(at) for file in files for at in range(file.metadata.num_row_groups)]
    assert sum(group.num_rows for group in groups) == 3000 and len(groups) > 2
    for group in groups:
        assert group.total_byte_size < 1 << 18
        columns = {group.column(at).path_in_schema: group.column(at) for at in range(group.num_columns)}
        assert any("DICTIONARY" in x for x in columns["ids.list.element"].encodings)
        for name in ("doc_id", "part_start", "n_tokens"):
            assert "DELTA_BINARY_PACKED" in columns[name].encodings and not columns[name].has_dictionary_page
        assert all(column.has_offset_index and column.has_column_index for column in columns.values())
        assert columns["doc_id"].statistics.has_min_max
    ranges = sorted((g.column(0).statistics.min, g.column(0).statistics.max) for g in groups)
    assert all(a[1] < b[0] for a, b in zip(ranges[:-1], ranges[1:], strict=True))
