"""Every registered query against plain Python, on documents with every odd case, and on no documents."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import odd
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from tillcube.llm import line_dedup, packing, quality_rules
from tillcube.llm.queries import QUERIES
from tillcube.llm.tokens import tokenizer_path

ROWS = [(row[0], row[1]) for row in odd.rows()]


@pytest.fixture(scope="module")
def run(spark, odd_folder):
    return lambda name: QUERIES[name](spark, odd_folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_documents(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


def test_quality_rules_count_as_python_does(run):
    expected = []
    for doc_id, text in ROWS:
        counts = odd.statistics(text)
        expected.append((doc_id, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = run("op1_quality_rules").collect()
    assert odd.many((r.doc_id, *(r[name] for name in names), r.base_failed) for r in found) == odd.many(expected)
    assert not any(row.kept and row.base_failed for row in found)


def test_shards_are_contiguous_and_equal_in_bytes(run):
    found = run("op2_sharding").collect()
    size = {id(row): len((row[1] or "").encode()) + 1 for row in ROWS}
    crc = [(doc_id, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for doc_id, text in ROWS]
    assert odd.many((r.doc_id, r["size"], r.text_crc32) for r in found) == odd.many(crc)
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    total, at = sum(size.values()), 0
    slots = defaultdict(list)
    for row in sorted(found, key=lambda r: (r.shard, r.slot)):
        assert row.shard == (2 * at + row["size"]) * 8 // (2 * total)
        at += row["size"]
        slots[row.shard].append(row.slot)
    assert all(found == list(range(len(found))) for found in slots.values())
    ids = [row.doc_id or 0 for row in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert ids == sorted(ids)


def passages(docs, least=50):
    """For each document which of its lines lie in a run of lines that an earlier document has too, with so many words."""
    places, covered = defaultdict(list), {}
    for doc_id in sorted(docs):
        lines = docs[doc_id]
        sizes, found = [len(odd.words(line)) for line in lines], [False] * len(lines)
        aligned = defaultdict(list)
        for at, line in enumerate(lines):
            for other, there in places[line]:
                aligned[other, there - at].append(at)
        for same in aligned.values():
            first = 0
            for at in range(len(same)):
                if at + 1 == len(same) or same[at + 1] != same[at] + 1:
                    if sum(sizes[x] for x in same[first : at + 1]) >= least:
                        for x in same[first : at + 1]:
                            found[x] = True
                    first = at + 1
        covered[doc_id] = found
        for at, line in enumerate(lines):
            places[line].append((doc_id, at))
    return covered


def removed_lines(row):
    return {at for span in row.removed for at in range(span.first_line, span.first_line + span.n_lines)}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_line_dedup_finds_repeated_passages(spark, folder):
    found = {row.doc_id: row for row in QUERIES["op3_line_dedup"](spark, folder).collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    docs = {doc_id: text.split("\n") if text else [] for doc_id, text in texts}
    covered = passages(docs)
    wanted = [(doc_id, at) for doc_id, marks in covered.items() for at, mark in enumerate(marks) if mark and odd.words(docs[doc_id][at])]
    hit = sum(at in removed_lines(found[doc_id]) for doc_id, at in wanted)
    assert len(wanted) > 50 and hit == len(wanted)
    kept = {line for doc_id, lines in docs.items() for at, line in enumerate(lines) if at not in removed_lines(found[doc_id])}
    for doc_id, lines in docs.items():
        gone = removed_lines(found[doc_id])
        # What stays is the text without the removed lines, and nothing that is removed is lost.
        assert (found[doc_id].text or "") == "\n".join(line for at, line in enumerate(lines) if at not in gone)
        assert {lines[at] for at in gone} <= kept
        for span in found[doc_id].removed:
            run = lines[span.first_line : span.first_line + span.n_lines]
            assert span.n_lines > 1 or len(odd.words(run[0])) >= 50


def test_line_dedup_of_odd_documents(run):
    rows = run("op3_line_dedup").collect()
    texts = Counter((doc_id, text) for doc_id, text in ROWS)
    assert len(rows) == len(ROWS) and sum(texts.values()) == len(ROWS)
    # No line of words is lost: it stays in some row.
    before = {line for _, text in ROWS for line in (text or "").split("\n")}
    after = {line for row in rows for line in (row.text or "").split("\n")}
    assert {line for line in before if odd.words(line)} <= after
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row)
    ids = {text: doc_id for doc_id, text in ROWS if text and text.startswith("start\n")}
    (copied,) = (by_id[doc_id][0] for doc_id in ids.values())
    assert copied.text == "start" and [tuple(x)[:2] for x in copied.removed] == [(1, 3)]


def test_a_passage_is_found_wherever_it_stands(spark):
    passage = [odd.prose(seed, 9) for seed in range(40)]
    docs = [(at, "\n".join([*(odd.prose(1000 * at + x, 9) for x in range(3 + at)), *passage, odd.prose(at, 8)]))
            for at in range(1, 6)]
    cut = line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for row in cut:
        left = sum(line in row.text.split("\n") for line in passage)
        assert left == (40 if row.doc_id == 1 else 0)
        assert len(row.text.split("\n")) == left + 4 + row.doc_id
    one_line = odd.prose(77, 60)
    docs = [(at, f"{odd.prose(at, 10)}\n{one_line}\n{odd.prose(-at, 10)}") for at in range(1, 6)]
    cut = line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(row.doc_id for row in cut if one_line in row.text) == [1]


def test_a_passage_of_three_lines_goes_whole(spark):
    """Fifty-one words in three lines, between other lines, in many places: whatever boundaries fall where."""
    docs, passage = [], {}
    for group in range(60):
        passage[group] = [odd.prose(50_000 + 10 * group + x, 17) for x in range(3)]
        for copy in range(3):
            around = [odd.prose(90_000 + 100 * group + 10 * copy + x, 6) for x in range(2 + copy)]
            docs.append((group + 100 * copy, "\n".join([*around, *passage[group], odd.prose(group - 7000 * copy, 5)])))
    cut = line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    left = sum(line in row.text.split("\n") for row in cut for line in passage[row.doc_id % 100] if row.doc_id >= 100)
    assert left == 0
    assert all(line in row.text for row in cut for line in passage[row.doc_id % 100] if row.doc_id < 100)


def test_the_same_line_again_and_again(spark):
    docs = [(1, "\n".join(["the same line here"] * 400)), (2, "\n" * 5000 + "end"), (3, "\n" * 5000 + "end")]
    cut = {row.doc_id: row for row in line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert 0 < cut[1].text.count("the same line here") < 30 and cut[2].text.strip() == "end"


def test_exact_copies_of_short_lines_go_whole(spark):
    texts = ["\n".join(odd.prose(100 * at + x, 9) for x in range(2 + at)) for at in range(12)]
    # A long line, with a short one alone on each side of it or two.
    texts += ["\n".join([*(odd.prose(7000 + 10 * at + x, 9) for x in range(2)), odd.prose(8000 + at, 60),
                         *(odd.prose(9000 + 10 * at + x, 9) for x in range(3))]) for at in range(6)]
    docs = [(at + 100 * copy, text) for at, text in enumerate(texts) for copy in range(2)]
    cut = line_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert odd.many((r.doc_id, r.text) for r in cut) == odd.many((i, text if i < 100 else "") for i, text in docs)


def pieces_of(ids):
    head = len(ids) % 1024
    starts = ([0] if head else []) + list(range(head, len(ids), 1024))
    return [(at, start, ids[start : start + (head if head and not at else 1024)]) for at, start in enumerate(starts)]


def best_fit(lengths, capacity):
    """Sequences that best-fit opens when it takes one piece after the other, longest first."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at == len(gaps):
            opened += 1
            bisect.insort(gaps, capacity - length)
        else:
            bisect.insort(gaps, gaps.pop(at) - length)
    return opened


def test_sweeps_open_as_many_sequences_as_one_piece_at_a_time():
    draw = random.Random(4)
    for capacity in (1, 7, 64, 1024):
        for _ in range(30):
            lengths = [draw.randrange(1, capacity + 1) // draw.choice([1, 1, 5]) or 1 for _ in range(draw.randrange(400))]
            plan = packing.sweep(Counter(lengths), capacity)
            places = {(p.sequence + at // p.each, p.offset + at % p.each * p.length, p.length)
                      for p in plan for at in range(p.count)}
            assert Counter(length for _, _, length in places) == Counter(lengths)
            ends = defaultdict(int)
            for sequence, offset, length in sorted(places):
                assert ends[sequence] == offset
                ends[sequence] += length
            assert max(ends.values(), default=0) <= capacity
            assert len(ends) == best_fit(lengths, capacity)


def test_packing(run):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected += [(doc_id, at, start, len(part), odd.checksum(part)) for at, start, part in pieces_of(ids)]
    found = run("op4_best_fit_packing").collect()
    assert odd.many((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == odd.many(expected)
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == best_fit([row.length for row in found], 1024)


def test_classifier_scores_every_text(run):
    found = run("op5_quality_classifier").collect()
    assert odd.many(r.doc_id for r in found) == odd.many(doc_id for doc_id, _ in ROWS)
    for row in found:
        held = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1
        assert row.held_out == held and 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)


def fingerprint(text):
    found = odd.words(re.sub("[A-Z]", lambda letter: letter[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[at : at + 3]) for at in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(value >> bit & 1 for value in hashes) > len(hashes))


def test_simhash_components(run):
    prints = [(doc_id, fingerprint(text)) for doc_id, text in ROWS]
    lowest = {}
    left = sorted({value for _, value in prints})
    while left:
        group, new = set(), [left[0]]
        while new:
            group |= set(new)
            new = [x for x in left if x not in group and any((x ^ y).bit_count() <= 2 for y in new)]
        ids = [doc_id for doc_id, value in prints if value in group and doc_id is not None]
        lowest |= {value: min(ids, default=None) for value in group}
        left = [x for x in left if x not in group]
    expected = odd.many((doc_id, f"{value:016x}", lowest[value]) for doc_id, value in prints)
    found = run("op6_simhash_near_dedup").collect()
    assert odd.many((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected


def test_exact_groups(run):
    groups = defaultdict(list)
    for doc_id, text in ROWS:
        groups[re.sub(odd.BLANK, " ", text or "")].append(doc_id)
    expected = []
    for text, ids in groups.items():
        keep = min((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for place, doc_id in enumerate(sorted(ids, key=lambda x: (x is None, x))):
            expected.append((doc_id, keep, len(ids), place == 0, digest))
    found = run("op7_exact_dedup").collect()
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert odd.many(tuple(r[name] for name in names) for r in found) == odd.many(expected)


def test_token_files(run):
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    encoded = [(doc_id, [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]) for doc_id, text in ROWS]
    found = sorted(run("op8_token_files").collect(), key=lambda row: row.start)
    assert odd.many((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == odd.many(
        (doc_id, len(ids), odd.checksum(ids)) for doc_id, ids in encoded
    )
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens
    ids = [row.doc_id or 0 for row in found]
    assert ids == sorted(ids)


def test_token_counts(run):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in ROWS:
        count = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), count, count > 1024))
    found = run("op9_token_counts").collect()
    assert odd.many((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == odd.many(expected)


def test_sentencepiece_equals_the_library(run):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    expected = odd.many((doc_id, tuple(model.encode(text or ""))) for doc_id, text in ROWS)
    found = run("op10_sentencepiece").collect()
    assert odd.many((r.doc_id, tuple(r.ids)) for r in found) == expected
    assert all(r.decoded_equal and r.n_tokens == len(r.ids) and r.ids_crc32 == odd.checksum(r.ids) for r in found)


def test_rules_decide_in_order(spark):
    """The emitted expression against the rules read one by one."""
    rules = [
        (quality_rules.Condition("symbol_share", True, 0.1),),
        (quality_rules.Condition("distinct_share", False, 0.3), quality_rules.Condition("n_words", True, 50.0)),
    ]
    docs = spark.createDataFrame([(1, "a *** b " * 9), (2, "same " * 90), (3, "same " * 9), (4, odd.prose(1, 90))], "doc_id long, text string")
    assert sorted(row.doc_id for row in quality_rules.keep(docs.where("doc_id <> 3"), rules).collect()) == [4]
