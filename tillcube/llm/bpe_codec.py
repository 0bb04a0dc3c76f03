"""Byte-pair encoding and decoding of whole texts by a tokenization automaton.

A text is cut at special strings and then into words by the tokenizer's own first split; each distinct word goes once
through the automaton that is compiled from the vocabulary's merges (see ``merge_automaton``), and decoding emits the labels
of its arcs. Every worker process compiles the vocabulary once; nothing is shuffled or sent.

Defined cases: a null text is encoded as the empty one, without ids; null ids decode to null; bytes that are not UTF-8
are decoded to replacement characters; repeated rows and rows without id are encoded each; extra columns are left out; an
empty table gives no rows; words of any length are read in memory in proportion to them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.llm.merge_automaton import MergeAutomaton, byte_letters, read_vocabulary
from tillcube.llm.segments import FIRST, WORDS, SegmentEncoder, gathered
from tillcube.llm.tokens import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
# Parts remembered by one worker process.
REMEMBERED = 400_000

ENCODED = "doc_id long, ids array<int>"
DECODED = "doc_id long, ids array<int>, text string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


class AutomatonEncoder(SegmentEncoder):
    """Encodes parts of texts that were not met before with the automaton instead of the library's merging."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__(path, True, remembered)
        self.labels, merges, self.special = read_vocabulary(path)
        of_special = set(self.special.values())
        self.automaton = MergeAutomaton([None if i in of_special else x for i, x in enumerate(self.labels)], merges)
        self.label_lengths = np.array([len(x or b"") for x in self.labels], np.int64)
        self.label_at = np.r_[0, np.cumsum(self.label_lengths)][:-1]
        self.label_bytes = np.frombuffer(b"".join(x or b"" for x in self.labels), np.uint8)
        self._letters = str.maketrans({letter: chr(byte) for letter, byte in byte_letters().items()})
        names = "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True))
        self._cut = re.compile(f"({names})") if names else None

    def _words(self, text: str) -> list[bytes]:
        """Words of the first split, in bytes."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return [word.translate(self._letters).encode("latin-1") for word, _ in split(text)]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        place: dict[bytes | int, int] = {}
        at: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            before = len(at)
            if WORDS.fullmatch(text[1:] if text[:1] == " " else text):
                at.append(place.setdefault(text.encode(), len(place)))
            else:
                for part in self._cut.split(text) if self._cut else [text]:
                    if part in self.special:
                        at.append(place.setdefault(self.special[part], len(place)))
                    elif part:
                        at += [place.setdefault(word, len(place)) for word in self._words(part)]
            counts[row] = len(at) - before
        special = np.fromiter((isinstance(x, int) for x in place), bool, len(place))
        ids, begin = self.automaton.encode([x if isinstance(x, bytes) else b"" for x in place])
        lengths, first = np.diff(begin), begin[:-1].copy()
        if special.any():
            own = np.array([x for x in place if isinstance(x, int)], np.uint32)
            first[special], lengths[special] = len(ids) + np.arange(len(own)), 1
            ids = np.concatenate([ids, own])
        chosen = np.array(at, np.int64)
        out, ends = gathered(ids, first[chosen], lengths[chosen])
        return out, ends[np.r_[0, np.cumsum(counts)]]

    def _encode_keys(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._encode([self._text(key) for key in keys])

    def decode_all(self, ids: np.ndarray, begin: np.ndarray) -> list[bytes]:
        """Texts of ids in UTF-8."""
        data, ends = gathered(self.label_bytes, self.label_at[ids], self.label_lengths[ids])
        joined, cuts = data.tobytes(), ends[begin].tolist()
        parts = (joined[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        return [part.decode("utf-8", "replace").encode() for part in parts]


_encoders: dict[str, AutomatonEncoder] = {}


def automaton_encoder(path: str) -> AutomatonEncoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = AutomatonEncoder(path)
    return _encoders[path]


def _encode_rows(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = automaton_encoder(path)
    for batch in batches:
        for rows, ids, begin in known.steps(batch, "text"):
            lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], _names(ENCODED))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    begin = np.r_[0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)), dtype=np.int64)]
    return np.asarray(lists.flatten()), begin


def _decode_rows(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = automaton_encoder(path)
    for batch in batches:
        lists = batch.column("ids")
        texts = pa.array(known.decode_all(*_flat(lists)), pa.binary()).cast(pa.string())
        texts = pc.if_else(pc.is_valid(lists), texts, pa.scalar(None, pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], _names(DECODED))


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, begin = _flat(batch.column("ids"))
        data, cuts = memoryview(ids.astype("<u4")).cast("B"), (begin * 4).tolist()
        of_ids = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        of_texts = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in batch.column("text").cast(pa.binary())]
        columns = [batch.column("doc_id"), pa.array(np.diff(begin)), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, _names(DIGESTS))


def _round_trip(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _digest_rows(_decode_rows(path, _encode_rows(path, batches)))


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every row."""
    return _texts(docs, id_column, text_column).mapInArrow(partial(_encode_rows, tokenizer_path(tokenizer)), ENCODED)


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id``, ``ids`` and ``text`` of rows with ``doc_id`` and ``ids``."""
    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(partial(_decode_rows, tokenizer_path(tokenizer)), DECODED)


def round_trip(docs: DataFrame, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, SHA-256 of the ids (little-endian, 32 bits) and of the text decoded from them, in one pass."""
    rows = _texts(docs, id_column, text_column)
    return rows.mapInArrow(partial(_round_trip, tokenizer_path(tokenizer)), DIGESTS)
