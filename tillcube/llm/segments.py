"""Encoding of many texts with a public tokenizer, each distinct segment once.

A byte-level tokenizer starts a new word at a single blank before a visible character, and the word
tokenizer drops blanks altogether, so a text may be cut there and its parts encoded alone: the
ids are those of the whole text. Most parts occur again and again, and a part met before costs a look-up.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# One thread a task: Spark already runs a task on every core.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

from tokenizers import Tokenizer  # noqa: E402

# Parts remembered by one worker process; beyond it parts are encoded again, with the same ids.
REMEMBERED = 800_000
# Bytes of text, and parts not met before, that are worked on at once.
STEP_BYTES = 4 << 20
STEP_PARTS = 2_000
# Words that are encoded as one text.
LINE_WORDS = 40
# A blank that is not followed by a visible character does not start a word.
NOT_A_START = (
    r" (?:[\x{0}-\x{20}\x{7f}-\x{a0}\x{ad}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}"
    r"\x{3000}\x{feff}]|$)|\x{0}"
)
# Parts that fall into words for certain, whatever the tokenizer: letters, with a full stop or comma after them,
# on one line or several.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
PLAIN = re.compile(f"{LETTERS}+[.,]?(?:\n{LETTERS}+[.,]?)*")
WORDS = re.compile(f"{LETTERS}+")
ATOM = re.compile(f"{LETTERS}+|[.,\n]")
# A mark that ends a word of letters, and the end of a line between two words: parts of their own.
ENDING = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,])([ \n]|$)"
BREAK = "([A-Za-zÀ-ÖØ-öø-ÿ.,])\n([A-Za-zÀ-ÖØ-öø-ÿ])"
# Marks a part that begins its text, and so has no blank before it.
FIRST = "\x00"
MARK, NOTHING = pa.scalar(FIRST, pa.large_string()), pa.scalar("", pa.large_string())


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class SegmentEncoder:
    """Gives the ids that the tokenizer in ``path`` gives for whole texts, without added special tokens.

    ``leading_blank`` says whether a blank belongs to the word after it (byte-level) or is dropped.
    """

    step_bytes = STEP_BYTES
    spreads = True

    def __init__(self, path: str, leading_blank: bool, remembered: int = REMEMBERED):
        self.tokenizer = load(path)
        self.leading_blank = leading_blank
        self.remembered = remembered
        # Ids that begin a word (byte-level, where the blank is written so) or end one.
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self._edge = np.array([x.startswith("Ġ") if leading_blank else x.endswith("</w>") for x in names])
        self._place: dict[str, int] = {}
        self._from = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each begins, with the end."""
        found = []
        for at in range(0, len(texts), STEP_PARTS):
            step = self.tokenizer.encode_batch_fast(texts[at : at + STEP_PARTS], add_special_tokens=False)
            found.append(_joined([x.ids for x in step]))
        return _in_a_row(found)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only: many to a text, for a text costs more than a word. Which ids begin or
        end a word shows in the vocabulary."""
        lead = " " if self.leading_blank else ""
        lines = [lead + " ".join(words[at : at + LINE_WORDS]) for at in range(0, len(words), LINE_WORDS)]
        ids, _ = self._encode(lines)
        at = np.flatnonzero(self._edge[ids])
        begin = np.r_[at, len(ids)] if self.leading_blank else np.r_[0, at + 1]
        if len(begin) != len(words) + 1:
            raise ValueError("the tokenizer does not keep words apart")
        return ids, begin

    def _encode_keys(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        word = np.fromiter((WORDS.fullmatch(key) is not None for key in keys), bool, len(keys))
        if not len(keys) or not word.any():
            return self._encode([self._text(key) for key in keys])
        parts = (
            self._encode_words([key for key, own in zip(keys, word, strict=True) if own]),
            self._encode([self._text(key) for key, own in zip(keys, word, strict=True) if not own]),
        )
        lengths, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        lengths[word], lengths[~word] = (np.diff(begin) for _, begin in parts)
        first[word], first[~word] = parts[0][1][:-1], len(parts[0][0]) + parts[1][1][:-1]
        return gathered(np.concatenate([ids for ids, _ in parts]), first, lengths)

    def _atoms(self, key: str) -> list[str]:
        """Keys of the parts of a part that are words to the tokenizer for certain: runs of letters, single marks
        and single line ends between them."""
        if not self.leading_blank or key.isalpha():
            return [key]
        first = key[:1] == FIRST
        body = key[first:]
        if not PLAIN.fullmatch(body):
            return [key]
        atoms = ATOM.findall(body)
        return [atoms[0] if not first else key[:1] + atoms[0], *(FIRST + x for x in atoms[1:])]

    def _text(self, key: str) -> str:
        if not self.leading_blank:
            return key
        return key[1:] if key[:1] == FIRST else f" {key}"

    def _known(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of every key in a table of ids: (place, ids, from)."""
        place = np.fromiter(map(self._place.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place, self._ids, self._from
        fresh = [keys[at] for at in new]
        parts = [self._atoms(key) for key in fresh]
        unknown = [x for x in dict.fromkeys(chain.from_iterable(parts)) if x not in self._place]
        ids, begin = self._encode_keys(unknown)
        first = len(self._from) - 1
        passing = dict(zip(unknown, range(first, first + len(unknown)), strict=True))
        all_ids = np.concatenate([self._ids, ids])
        all_from = np.concatenate([self._from, self._from[-1] + begin[1:]])
        atoms = [self._place[x] if x in self._place else passing[x] for x in chain.from_iterable(parts)]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        joined, ends = gathered(all_ids, all_from[atoms], np.diff(all_from)[atoms])
        begin = ends[np.r_[0, np.cumsum(counts)]]
        place[new] = len(all_from) - 1 + np.arange(len(new))
        self._remember(unknown, all_ids, all_from)
        often = [i for i, (key, n) in enumerate(zip(fresh, counts.tolist(), strict=True)) if n > 1 and "\n" not in key]
        self._remember([fresh[i] for i in often], *gathered(joined, begin[often], np.diff(begin)[often]), True)
        return place, np.concatenate([all_ids, joined]), np.concatenate([all_from, all_from[-1] + begin[1:]])

    def _remember(self, keys: list[str], ids: np.ndarray, begin: np.ndarray, append: bool = False) -> None:
        """Keep as many new keys as there is room for. ``ids`` and ``begin`` hold the known ones before
        the new ones, or, to ``append``, the new ones alone."""
        if append:
            ids, begin = np.concatenate([self._ids, ids]), np.concatenate([self._from, self._from[-1] + begin[1:]])
        first = len(self._from) - 1
        kept = min(len(keys), max(0, self.remembered - first))
        self._place.update(zip(keys[:kept], range(first, first + kept), strict=True))
        self._from = begin[: first + kept + 1]
        self._ids = ids[: self._from[-1]]

    def steps(self, batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Some rows of the batch after the other, each time with the ids of their texts as for ``encode``."""
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // self.step_bytes)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = batch.slice(a, b - a)
            yield rows, *self.encode(rows.column(column))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other as unsigned 32-bit numbers, and where each text's
        ids begin, with the end. Null counts as the empty text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.leading_blank:
            return self._encode_parts(texts)
        plain = pc.invert(pc.match_substring_regex(texts, NOT_A_START))
        if pc.all(plain).as_py():
            return self._encode_parts(texts)
        chosen = np.asarray(plain)
        other_ids, other_from = self._encode(texts.filter(pc.invert(plain)).to_pylist())
        part_ids, part_from = self._encode_parts(texts.filter(plain))
        lengths = np.zeros(len(texts), np.int64)
        lengths[chosen], lengths[~chosen] = np.diff(part_from), np.diff(other_from)
        begin = np.zeros(len(texts), np.int64)
        begin[chosen], begin[~chosen] = part_from[:-1], len(part_ids) + other_from[:-1]
        return gathered(np.concatenate([part_ids, other_ids]), begin, lengths)

    def _spread(self, texts: pa.Array) -> pa.Array:
        """The texts with blanks put between parts, so that they are split there, in fewer spellings.

        For a byte-level tokenizer a part after such a blank begins with the mark that says that it has none. One that drops
        blanks and writes letters small needs no mark and has no capitals; texts that may hold a special string
        stay as they are."""
        if self.leading_blank:
            texts = pc.replace_substring_regex(texts, ENDING, rf"\1 {FIRST}\2\3")
            return pc.replace_substring_regex(texts, BREAK, f"\\1 {FIRST}\n {FIRST}\\2")
        # The first step copies: ascii_lower gives wrong offsets for a slice of a longer array.
        plain = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        plain = pc.replace_substring_regex(plain, ENDING, r"\1 \2\3")
        return pc.if_else(pc.match_substring(texts, "<"), texts, plain)

    def _encode_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if self.spreads:
            texts = self._spread(texts)
        lists = pc.split_pattern(texts, " ")
        bounds = np.asarray(lists.offsets)
        parts = lists.flatten()
        bounds = bounds - bounds[0]
        if self.leading_blank:
            first = np.zeros(len(parts), bool)
            first[bounds[:-1]] = True
            heads = pc.binary_join_element_wise(MARK, parts.filter(pa.array(first)), NOTHING)
            parts = pc.replace_with_mask(parts, pa.array(first), heads)
        coded = parts.dictionary_encode()
        place, ids, begin = self._known(coded.dictionary.to_pylist())
        at = place[np.asarray(coded.indices)]
        lengths = begin[at + 1] - begin[at]
        out, ends = gathered(ids, begin[at], lengths)
        return out, ends[bounds]


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    begin = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=begin[1:])
    ids = np.fromiter(chain.from_iterable(lists), np.uint32, begin[-1])
    return ids, begin


def _in_a_row(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One (ids, begin) of several."""
    if not found:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    before = np.cumsum([0, *(len(ids) for ids, _ in found)])
    begins = [begin[:-1] + first for (_, begin), first in zip(found, before, strict=False)]
    return np.concatenate([ids for ids, _ in found]), np.r_[np.concatenate(begins), before[-1]]


def gathered(values: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of ``values`` one after the other, and where each begins, with the end."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    at = np.arange(ends[-1], dtype=np.int64)
    at += np.repeat(begin - ends[:-1], lengths)
    return values[at], ends


_encoders: dict[tuple[str, bool], SegmentEncoder] = {}


def encoder(path: str, leading_blank: bool) -> SegmentEncoder:
    """The encoder of this worker process."""
    key = (path, leading_blank)
    if key not in _encoders:
        # Words written small and set apart come again more often, so fewer need to be remembered.
        _encoders[key] = SegmentEncoder(path, leading_blank, REMEMBERED if leading_blank else REMEMBERED // 2)
    return _encoders[key]
