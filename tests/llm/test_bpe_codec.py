"""The tokenization automaton against merging by hand and against the library."""

import hashlib
import random

import numpy as np
import odd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillcube.llm import bpe_codec
from tillcube.llm.bpe_codec import AutomatonEncoder
from tillcube.llm.merge_automaton import MergeAutomaton
from tillcube.llm.queries import QUERIES
from tillcube.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return AutomatonEncoder(PATH, remembered=500)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def merged(word, merges):
    """Merges by hand: each in the order of its rank, from left to right."""
    tokens = list(word)
    for u, v, whole in merges:
        at = 0
        while at + 1 < len(tokens):
            if tokens[at : at + 2] == [u, v]:
                tokens[at : at + 2] = [whole]
            at += 1
    return tokens


def test_random_vocabularies_against_merging_by_hand():
    draw = random.Random(5)
    for _ in range(60):
        labels = [bytes([x]) for x in range(3)]
        merges = []
        for _ in range(draw.randrange(25)):
            u, v = draw.randrange(len(labels)), draw.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                merges.append((u, v, len(labels)))
                labels.append(labels[u] + labels[v])
        automaton = MergeAutomaton(labels, merges)
        assert len(automaton.lacks) <= len(merges) + 1
        words = [bytes(draw.randrange(3) for _ in range(draw.choice([0, 1, 2, 5, 20, 150, 400]))) for _ in range(60)]
        ids, begin = automaton.encode(words)
        for at, word in enumerate(words):
            assert ids[begin[at] : begin[at + 1]].tolist() == merged(word, merges)


def test_words_of_the_vocabulary_side_by_side(encoder, library):
    draw = random.Random(6)
    names = [x for x in encoder.labels if x and len(x) > 1]
    texts = [b"".join(draw.choices(names, k=draw.randrange(1, 6))).decode("utf-8", "replace") for _ in range(6000)]
    texts += [letter * n for letter in ("a", " ", "=", "é", "ab", "\n") for n in range(1, 240, 7)]
    texts += ["the" * 5000, "x" * 70_000, " " * 3000 + "end", *(x or "" for x in odd.texts())]
    signs = ["a", "b ", " ", "\n", "'s", "1", "é", "!", "<|endoftext|>", "<|endof", "\xa0", "中", "  ", "\t", "́", "A", ". "]
    texts += ["".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(1500)]
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, begin = encoder.encode(pa.array(texts, pa.string()))
        decoded = encoder.decode_all(ids, begin)
        for at, text in enumerate(texts):
            assert ids[begin[at] : begin[at + 1]].tolist() == expected[at]
            assert decoded[at].decode() == text


def test_every_query_row_is_that_of_the_library(spark, odd_folder, library):
    expected = []
    for row in odd.rows():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode()))
        expected.append((row[0], len(ids), *digests))
    found = QUERIES["op11_bpe_automaton"](spark, odd_folder).collect()
    assert odd.many((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == odd.many(expected)


def test_ids_decode_as_the_library_decodes_them(spark, library):
    draw = random.Random(7)
    # Any ids, whose bytes need not be UTF-8.
    lists = [draw.choices(range(50257), k=draw.randrange(12)) for _ in range(400)]
    table = spark.createDataFrame([*enumerate(lists), (None, None)], "doc_id long, ids array<int>")
    found = {row.doc_id: row.text for row in bpe_codec.decode(table).collect()}
    assert found.pop(None) is None
    assert found == {at: library.decode(ids, skip_special_tokens=False) for at, ids in enumerate(lists)}


def test_texts_come_back(spark, odd_folder):
    from tillcube.llm.tables import documents

    docs = documents(spark, odd_folder)
    back = bpe_codec.decode(bpe_codec.encode(docs)).select("doc_id", "text")
    plain = docs.fillna("", "text").select("doc_id", "text")
    assert back.exceptAll(plain).isEmpty() and plain.exceptAll(back).isEmpty()
