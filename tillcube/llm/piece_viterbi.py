"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

A piece model of the merging kind gives a text the one segmentation in which every two neighbours are stable: merging
the two pieces' characters from scratch gives the same two pieces. So the best path is a Viterbi path whose step
from piece to piece scores 0 if the pair is stable and minus infinity if not, and the last piece of every prefix is
unique. Adding up the pieces' scores instead, as for unigram models, would not give this model's ids: its scores are
ranks of merges.

All distinct words of one length advance together. Hashes of their substrings probe the sorted hashes of the pieces;
for each place in the words the candidates that end there are scored at once, and a maximum over their lengths stores the
backpointer. Runs of blanks have pieces of their own that all merge last; they are laid out by length.

Defined cases: a null or empty text has no ids; a character without a piece becomes its bytes; a text may hold the
blank sign itself, which decodes to a blank; ids out of the model's range are an error; extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tillcube.llm.segments import SegmentEncoder, gathered
from tillcube.llm.tokens import checksums, tokenizer_path

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
NONE = -1
# Two odd multipliers: substrings are found by one hash and confirmed by the other.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
# Places (words times length) that are searched at once.
STEP_PLACES = 2_000_000
PAIRS_REMEMBERED = 2_000_000


def _characters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def _prefix_hashes(points: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for at in range(points.shape[1]):
        out[:, at + 1] = out[:, at] * base + points[:, at].astype(np.uint64) + np.uint64(1)
    return out


class PieceModel:
    """The pieces of a model, sorted by hash, and which pairs of them are stable."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(self.size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.size)]
        self.byte_ids = np.zeros(256, np.uint32)
        self.texts: list[bytes] = []
        normal = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            else:
                self.texts.append(b"" if special[i] else piece.replace(BLANK, " ").encode())
                if not special[i]:
                    normal.append(i)
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        self.bytes_of = np.array([*map(len, self.texts)], np.int64)
        self.bytes_at = np.cumsum(self.bytes_of) - self.bytes_of
        self.run_ids = {len(self.pieces[i]): i for i in normal if not self.pieces[i].strip(BLANK)}
        worded = [i for i in normal if self.pieces[i].strip(BLANK)]
        least = min(model.get_score(i) for i in worded)
        if any(BLANK in self.pieces[i][1:] for i in worded) or any(model.get_score(i) >= least for i in self.run_ids.values()):
            raise ValueError("only models whose pieces hold one blank at most, or blanks alone that merge last, are known")
        self._place = {self.pieces[i]: i for i in normal if self.pieces[i].strip(BLANK) or self.pieces[i] == BLANK}
        self.longest = max(map(len, self._place))
        # Characters of a piece; one for a character that has none.
        self.piece_sizes = np.array([*map(len, self.pieces), 1], np.int64)
        # A pair merges before another if its piece has the higher score, that is the lower rank.
        order = sorted(self._place.values(), key=lambda i: -model.get_score(i))
        self.rank = np.full(self.size + 1, self.size, np.int64)
        self.rank[order] = np.arange(len(order))
        self._hash_pieces()
        self._trees()
        self._remembered = (np.zeros(0, np.int64), np.zeros(0, bool))

    def _hash_pieces(self) -> None:
        ids, hashes = [], []
        by_length: dict[int, list[int]] = {}
        for piece, i in self._place.items():
            by_length.setdefault(len(piece), []).append(i)
        for length, group in by_length.items():
            points = _characters([self.pieces[i] for i in group], length)
            ids += group
            hashes.append(np.stack([_prefix_hashes(points, base)[:, -1] for base in BASES], 1))
        both = np.concatenate(hashes)
        order = np.argsort(both[:, 0])
        self.hashes, self.ids = both[order], np.array(ids, np.int64)[order]
        if (self.hashes[1:, 0] == self.hashes[:-1, 0]).any():
            raise ValueError("two pieces have one hash")

    def _trees(self) -> None:
        """The two parts that a piece is merged from, and all pairs that merge into a piece."""
        self.left = np.full(self.size + 1, NONE, np.int64)
        self.right = np.full(self.size + 1, NONE, np.int64)
        self.whole = np.zeros(self.size + 1, bool)
        self.whole[self.size] = True  # a character without a piece stands for itself
        keys, merged = [], []
        for piece, i in self._place.items():
            parts = [(self._place.get(piece[:at]), self._place.get(piece[at:])) for at in range(1, len(piece))]
            for a, b in parts:
                if a is not None and b is not None:
                    keys.append(a * (self.size + 1) + b)
                    merged.append(i)
            last = self._last_merge(piece)
            if last is not None:
                self.whole[i] = True
                self.left[i], self.right[i] = last
        order = np.argsort(keys)
        self.pair_keys, self.pair_ids = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The last merge that makes the piece out of its characters; none if merging ends elsewhere."""
        parts = list(piece)
        last = (NONE, NONE)
        while len(parts) > 1:
            found = [
                (self.rank[i], at) for at in range(len(parts) - 1) if (i := self._place.get(parts[at] + parts[at + 1])) is not None
            ]
            if not found:
                return None
            at = min(found)[1]
            last = tuple(self._place.get(x, self.size) for x in parts[at : at + 2])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last

    def run(self, length: int) -> list[int]:
        """Ids of so many blanks: of the pairs that make a piece the leftmost merges first."""
        sizes: list[int] = []
        for _ in range(length):
            sizes.append(1)
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.run_ids:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return [self.run_ids[size] for size in sizes]

    def probe(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, or NONE."""
        at = np.minimum(np.searchsorted(self.hashes[:, 0], first), len(self.ids) - 1)
        found = (self.hashes[at, 0] == first) & (self.hashes[at, 1] == second)
        return np.where(found, self.ids[at], NONE)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces stays a pair when its characters are merged from scratch."""
        keys, back = np.unique(a * (self.size + 1) + b, return_inverse=True)
        known, answers = self._remembered
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        out = np.zeros(len(keys), bool)
        old = known[at] == keys if len(known) else np.zeros(len(keys), bool)
        out[old] = answers[at[old]] if len(known) else False
        new = np.flatnonzero(~old)
        if len(new):
            out[new] = self._compare(keys[new] // (self.size + 1), keys[new] % (self.size + 1))
            if len(known) + len(new) <= PAIRS_REMEMBERED:
                spots = np.searchsorted(known, keys[new])
                self._remembered = np.insert(known, spots, keys[new]), np.insert(answers, spots, out[new])
        return out[back]

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No part that ends the left piece merges with one that begins the right one before both go into larger parts.

        ``x`` runs down the parts that end the left piece, ``y`` down those that begin the right one; each lasts
        until the merge of the part it goes into. Of equal merges the left one comes first.
        """
        stable = np.ones(len(a), bool)
        x, x_until, which = a.copy(), np.full(len(a), self.size + 1), np.arange(len(a))
        while len(which):
            y, y_until, rows = b[which], np.full(len(which), self.size + 1), np.arange(len(which))
            while len(rows):
                keys = x[rows] * (self.size + 1) + y
                at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
                merged = np.where(self.pair_keys[at] == keys, self.rank[self.pair_ids[at]], self.size + 2)
                crossed = (merged < x_until[rows]) & (merged <= y_until)
                stable[which[rows[crossed]]] = False
                y_until, y, rows = self._down(self.left, y, rows, ~crossed)
            go = stable[which] & (self.right[x] != NONE)
            x_until = self.rank[x[go]]
            x, which = self.right[x[go]], which[go]
        return stable

    def _down(self, side: np.ndarray, y: np.ndarray, rows: np.ndarray, go: np.ndarray):
        go = go & (side[y] != NONE)
        return self.rank[y[go]], side[y[go]], rows[go]

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length one after the other, and where each begins, with the end. A character
        without a piece is ``size`` (to be replaced by its bytes)."""
        count, length = len(words), len(words[0])
        points = _characters(words, length)
        prefixes = [_prefix_hashes(points, base) for base in BASES]
        longest = min(self.longest, length)
        powers = [base ** np.arange(longest + 1, dtype=np.uint64) for base in BASES]
        last = np.full((count, length + 1), NONE, np.int64)  # the piece that ends each prefix
        back = np.zeros((count, length + 1), np.int64)
        reached = np.zeros((count, length + 1), bool)
        reached[:, 0] = True
        for end in range(1, length + 1):
            sizes = np.arange(1, min(longest, end) + 1)
            found = np.stack(
                [
                    self.probe(*(p[:, end] - p[:, end - n] * power[n] for p, power in zip(prefixes, powers, strict=True)))
                    for n in sizes
                ],
                1,
            )
            found[:, 0] = np.where(found[:, 0] == NONE, self.size, found[:, 0])
            row, at = np.nonzero((found != NONE) & self.whole[found] & reached[:, end - sizes])
            piece, before = found[row, at], last[row, end - sizes[at]]
            score = np.full(found.shape, -1, np.int64)
            good = np.ones(len(row), bool)
            inner = before != NONE
            good[inner] = self.stable(before[inner], piece[inner])
            score[row[good], at[good]] = sizes[at[good]]
            best = score.argmax(1)
            every = np.arange(count)
            reached[:, end] = score[every, best] > 0
            back[:, end] = np.where(reached[:, end], sizes[best], 0)
            last[:, end] = np.where(reached[:, end], found[every, best], NONE)
        if not reached[:, -1].all():
            raise ValueError("a word has no stable segmentation in this model")
        used = np.zeros((count, length + 1), bool)
        place = np.full(count, length)
        open_ = np.arange(count)
        while len(open_):
            used[open_, place[open_]] = True
            place[open_] -= back[open_, place[open_]]
            open_ = open_[place[open_] > 0]
        counts = used.sum(1)
        return last[used].astype(np.int64), np.r_[0, np.cumsum(counts)]


class PieceEncoder(SegmentEncoder):
    """Encodes whole texts word by word; a word is a blank and what follows it up to the next."""

    # Many words at once, for the search advances all words of a length together.
    step_bytes = 8 << 20
    spreads = False

    def __init__(self, path: str, remembered: int = 600_000):
        self.model = PieceModel(path)
        self.leading_blank = False
        self.remembered = remembered
        self._place = {}
        self._from = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = pc.or_(
            pc.match_substring_regex(texts, f"^ |  | $|{BLANK}"), pc.equal(pc.binary_length(texts), 0)
        ).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._encode_parts(texts)
        ids, begin = self._encode_parts(texts.filter(pa.array(~odd)))
        lists = [self._spaced(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        lengths = np.zeros(len(texts), np.int64)
        lengths[~odd], lengths[odd] = np.diff(begin), [len(x) for x in lists]
        others = np.concatenate([*lists, np.zeros(0, np.uint32)])
        first = np.zeros(len(texts), np.int64)
        first[~odd], first[odd] = begin[:-1], len(ids) + np.cumsum([0, *lengths[odd]])[:-1]
        return gathered(np.concatenate([ids, others]), first, lengths)

    def _spaced(self, text: str) -> np.ndarray:
        """Ids of a text with runs of blanks. The last blank of a run goes to the word if it merges with it."""
        if not text:
            return np.zeros(0, np.uint32)
        blank, out = self.model.run_ids[1], []
        found = re.findall(f"({BLANK}+)([^{BLANK}]*)", BLANK + text.replace(" ", BLANK))
        place, ids, begin = self._known([word for _, word in found if word])
        at = iter(place.tolist())
        for run, word in found:
            run_length, own = len(run), np.zeros(0, np.uint32)
            if word:
                here = next(at)
                own = ids[begin[here] : begin[here + 1]]
                run_length -= 1
                if own[0] == blank:
                    own, run_length = own[1:], run_length + 1
            out += self.model.run(run_length) + own.tolist()
        return np.array(out, np.uint32)

    def _atoms(self, key: str) -> list[str]:
        return [key]

    def _encode_keys(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._encode(keys)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each with a blank before it."""
        words = [BLANK + x for x in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        ids, lengths = [], np.zeros(len(words), np.int64)
        at = 0
        while at < len(order):
            size = int(sizes[order[at]])
            to = min(int(np.searchsorted(sizes[order], size, "right")), at + max(1, STEP_PLACES // size))
            group = order[at:to]
            found, begin = self._bytes(*self.model.search([words[i] for i in group]), [words[i] for i in group])
            ids.append(found)
            lengths[group] = np.diff(begin)
            at = to
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
        first = np.zeros(len(words), np.int64)
        first[order] = np.r_[0, np.cumsum(lengths[order])][:-1]
        return gathered(flat, first, lengths)

    def _bytes(self, ids: np.ndarray, begin: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by their bytes."""
        raw = np.flatnonzero(ids == self.model.size)
        if not len(raw):
            return ids.astype(np.uint32), begin
        # The characters come in the order of the words: find each by the characters before it in its word.
        ends = np.cumsum(self.model.piece_sizes[ids])
        word = np.searchsorted(begin, raw, "right") - 1
        into = ends[raw] - 1 - np.r_[0, ends][begin[word]]
        found = [self.model.byte_ids[list(words[w][at].encode())] for w, at in zip(word, into, strict=True)]
        counts = np.ones(len(ids), np.int64)
        counts[raw] = [len(x) for x in found]
        out = np.repeat(ids, counts).astype(np.uint32)
        # Every byte of such a character stands where the character stood.
        out[np.repeat(ids == self.model.size, counts)] = np.concatenate(found)
        return out, np.r_[0, np.cumsum(counts)][begin]

    def decode_all(self, ids: np.ndarray, begin: np.ndarray) -> list[str]:
        """Texts of ids: pieces side by side, without the blank put before the first word."""
        data, ends = gathered(self.model.bytes, self.model.bytes_at[ids], self.model.bytes_of[ids])
        joined, cuts = data.tobytes(), ends[begin].tolist()
        parts = (joined[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))
        return [part[part[:1] == b" " :].decode("utf-8", "replace") for part in parts]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]


_encoders: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


ENCODED = "doc_id long, n_tokens long, ids_crc32 long, ids array<int>"
DECODED = "doc_id long, text string"
CHECKED = "doc_id long, n_tokens long, ids_crc32 long, ids array<int>, decoded_crc32 long, decoded_equal boolean"


def _encode_rows(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = piece_encoder(path)
    for batch in batches:
        for rows, ids, begin in known.steps(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(np.diff(begin)),
                    pa.array(checksums(ids, begin)),
                    pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ],
                names=[x.split()[0] for x in ENCODED.split(", ")],
            )


def _decode_rows(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = piece_encoder(path)
    for batch in batches:
        lists = batch.column("ids")
        begin = np.r_[0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)), dtype=np.int64)]
        texts = pa.array(known.decode_all(np.asarray(lists.flatten()), begin), pa.string())
        texts = pc.if_else(pc.is_valid(lists), texts, pa.scalar(None, pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])


def encode(docs: DataFrame, model: str = MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_crc32`` and ``ids`` of every row."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode_rows, tokenizer_path(model)), ENCODED)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids``; null ids give null."""
    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(partial(_decode_rows, tokenizer_path(model)), DECODED)


def _encode_and_check(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = piece_encoder(path)
    for batch in batches:
        texts = (x.as_py() or "" for x in batch.column("text"))
        for rows in _encode_rows(path, iter([batch])):
            lists = rows.column("ids")
            decoded = known.decode_all(np.asarray(lists.values), np.asarray(lists.offsets))
            sums = pa.array([zlib.crc32(text.encode()) for text in decoded], pa.int64())
            equal = pa.array([a == b.replace(BLANK, " ") for a, b in zip(decoded, texts, strict=False)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*rows.columns, sums, equal], [x.split()[0] for x in CHECKED.split(", ")])


def encode_and_check(
    docs: DataFrame, model: str = MODEL, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As ``encode``, with the decoded text's checksum and whether it is the text again."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode_and_check, tokenizer_path(model)), CHECKED)
