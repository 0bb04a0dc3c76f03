"""A deterministic automaton over the tokens of a byte-pair vocabulary that accepts right tokenizations only.

It starts as one state with an arc back to itself for every byte. Each merge of u and v, in the order of their ranks, is a
gadget put into it: wherever an arc u is followed by an arc v, an arc for the merged token leads straight to where v led,
and the arc v behind u is taken away. A state that arcs of other tokens lead to as well is copied first, so all arcs of one
token lead to one state, and there is at most one state more than there are merges.

An arc that is missing for a token is missing for all tokens that later begin with it. Tokens are numbered so that these
lie side by side; the arcs that a state lacks are then a few ranges of numbers, and all transitions fit into a
sorted table of ranges. Its size depends on the vocabulary alone.

Every text has exactly one right tokenization, so of each prefix of a word exactly one is accepted: words are read
byte by byte from each place that a token can end at, many words at a time, along a trie of the tokens' bytes, and an arc
that the table has ends the prefix. Decoding emits the bytes on the arcs.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Sequence

import numpy as np

from tillcube.llm.segments import gathered

# Words read side by side, and bytes of a word that is read alone.
STEP_WORDS = 8_192
LONG_WORD = 200
NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others for letters
    from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


class MergeAutomaton:
    """Tables for the tokens ``labels`` (id to bytes; None for ids that no merge reaches) and ``merges`` (ids of left
    half, right half and whole, in the order of their ranks)."""

    def __init__(self, labels: Sequence[bytes | None], merges: Sequence[tuple[int, int, int]]):
        self.size = len(labels)
        self._build(labels, merges)
        self._lay_out(labels)

    def _build(self, labels: Sequence[bytes | None], merges: Sequence[tuple[int, int, int]]) -> None:
        self.target = np.full(self.size, -1, np.int64)
        single = [i for i, label in enumerate(labels) if label is not None and len(label) == 1]
        self.target[single] = 0
        target = self.target.tolist()
        # What a state lacks: token, and the merge that took its arc away. The state to begin at is no token's own.
        self.lacks: list[dict[int, int]] = [{}]
        arcs = [len(single) + 1]
        left: dict[int, int] = {}
        made: dict[int, int] = {}
        for rank, (u, v, whole) in enumerate(merges):
            if target[u] < 0 or target[v] < 0 or self._missing(self.lacks[target[u]], v, left, made):
                continue
            target[whole] = target[v]
            arcs[target[v]] += 1
            left[whole], made[whole] = u, rank
            state = target[u]
            if arcs[state] > 1:
                arcs[state] -= 1
                self.lacks.append(dict(self.lacks[state]))
                arcs.append(1)
                target[u] = state = len(self.lacks) - 1
            self.lacks[state][v] = rank
        self.target = np.array(target, np.int64)
        self.left, self.made = left, made

    @staticmethod
    def _missing(lacks: dict[int, int], token: int | None, left: dict[int, int], made: dict[int, int]) -> bool:
        """Whether the arc of the token, or of what it begins with since before the token was made, is taken away. Of
        equal halves the first two of a row merge, so that very merge's token is gone as well."""
        later = NEVER
        while token is not None:
            if lacks.get(token, NEVER) <= later and token in lacks:
                return True
            later, token = made.get(token, -1), left.get(token)
        return False

    def _lay_out(self, labels: Sequence[bytes | None]) -> None:
        tokens = np.flatnonzero(self.target >= 0).tolist()
        after: dict[int, list[int]] = {}
        for token in sorted(self.made, key=self.made.get, reverse=True):
            after.setdefault(self.left[token], []).append(token)
        self.number = np.full(self.size, -1, np.int64)
        end = np.zeros(self.size, np.int64)
        waiting = [(token, False) for token in tokens if token not in self.left]
        count = 0
        while waiting:
            token, below = waiting.pop()
            if below:
                end[token] = count
                continue
            self.number[token] = count
            count += 1
            waiting.append((token, True))
            waiting += [(x, False) for x in reversed(after.get(token, ()))]
        # Where the numbers end that a merge takes from a state: those of tokens made since, which come first among
        # those that begin with its right half.
        past: dict[int, int] = {}
        for token, rank in {(token, rank) for lacks in self.lacks for token, rank in lacks.items()}:
            others = after.get(token, [])
            later = bisect_right(others, -rank, key=lambda x: -self.made[x])
            past[rank] = int(end[others[later - 1]] if later else self.number[token] + 1)
        number, size = self.number.tolist(), self.size
        spans = sorted(
            (state * size + number[token], state * size + past[rank])
            for state, lacks in enumerate(self.lacks)
            for token, rank in lacks.items()
        )
        joined = [[-1, -1]]
        for a, b in spans:
            if a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        table = np.array(joined, np.int64)
        self.begins, self.ends = table[:, 0].copy(), table[:, 1].copy()
        self._begins, self._ends = self.begins.tolist(), self.ends.tolist()
        edges: dict[int, int] = {}
        self._token_at = {0: -1}
        for token in tokens:
            node = 0
            for byte in labels[token]:
                node = edges.setdefault(node << 8 | byte, len(edges) + 1)
            self._token_at[node] = token
        self._edges = edges
        self.edge = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[x] for x in self.edge.tolist()], np.int64)
        self.token_at = np.array([self._token_at.get(node, -1) for node in range(len(edges) + 1)], np.int64)
        self.lengths = np.array([len(x or b"") for x in labels], np.int64)
        self.bytes_at = np.r_[0, np.cumsum(self.lengths)][:-1]
        self.bytes = np.frombuffer(b"".join(x or b"" for x in labels), np.uint8)

    def has_arc(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = state * self.size + self.number[token]
        return self.ends[np.searchsorted(self.begins, key, "right") - 1] <= key

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words one after the other, and where each word's begin, with the end."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        alone = int(np.searchsorted(-sizes[order], -LONG_WORD, "left"))
        parts = [self._encode_alone(words[at]) for at in order[:alone].tolist()]
        lengths = np.zeros(len(words), np.int64)
        lengths[order[:alone]] = [len(x) for x in parts]
        for at in range(alone, len(order), STEP_WORDS):
            group = order[at : at + STEP_WORDS]
            found, counts = self._encode_together([words[i] for i in group.tolist()], sizes[group])
            parts.append(found)
            lengths[group] = counts
        first = np.zeros(len(words), np.int64)
        first[order] = np.r_[0, np.cumsum(lengths[order])][:-1]
        return gathered(np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint32), first, lengths)

    def _encode_together(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words, the longest first, and how many each has."""
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.r_[0, np.cumsum(sizes)][:-1]
        width = int(sizes[0]) + 1
        state = np.zeros((len(words), width), np.int64)
        last = np.full((len(words), width), -1, np.int64)
        for start in range(width - 1):
            word = np.arange(np.searchsorted(-sizes, -start, "left"))
            node = np.zeros(len(word), np.int64)
            length = 0
            while len(word):
                key = node << 8 | text[begin[word] + start + length]
                at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
                on = self.edge[at] == key
                word, node = word[on], self.child[at[on]]
                length += 1
                token = self.token_at[node]
                some = np.flatnonzero(token >= 0)
                some = some[self.has_arc(state[word[some], start], token[some])]
                state[word[some], start + length] = self.target[token[some]]
                last[word[some], start + length] = token[some]
                on = sizes[word] > start + length
                word, node = word[on], node[on]
        place = sizes.copy()
        used = np.zeros(last.shape, bool)
        open_ = np.flatnonzero(place > 0)
        while len(open_):
            token = last[open_, place[open_]]
            if (token < 0).any():
                raise ValueError("a word has no tokenization in this vocabulary")
            used[open_, place[open_]] = True
            place[open_] -= self.lengths[token]
            open_ = open_[place[open_] > 0]
        return last[used], used.sum(1)

    def _encode_alone(self, word: bytes) -> np.ndarray:
        """The same for one long word, place by place."""
        state, last = [0] * (len(word) + 1), [-1] * (len(word) + 1)
        number, target = self.number, self.target
        for start in range(len(word)):
            node, base = 0, state[start] * self.size
            for at in range(start, len(word)):
                node = self._edges.get(node << 8 | word[at], -1)
                if node < 0:
                    break
                token = self._token_at.get(node, -1)
                if token >= 0:
                    key = base + int(number[token])
                    if self._ends[bisect_right(self._begins, key) - 1] <= key:
                        state[at + 1], last[at + 1] = int(target[token]), token
        found, place = [], len(word)
        while place:
            if last[place] < 0:
                raise ValueError("a word has no tokenization in this vocabulary")
            found.append(last[place])
            place -= int(self.lengths[last[place]])
        return np.array(found[::-1], np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes on the arcs of all ids one after the other, and where each id's begin, with the end."""
        return gathered(self.bytes, self.bytes_at[ids], self.lengths[ids])


def read_vocabulary(path: str) -> tuple[list[bytes | None], list[tuple[int, int, int]], dict[str, int]]:
    """Labels, merges and added special strings (with their ids) of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    letters, vocabulary = byte_letters(), stored["model"]["vocab"]
    special = {x["content"]: x["id"] for x in stored["added_tokens"]}
    labels: list[bytes | None] = [None] * (1 + max([*vocabulary.values(), *special.values()]))
    for name, token in vocabulary.items():
        if all(letter in letters for letter in name):
            labels[token] = bytes(letters[letter] for letter in name)
    merges = []
    for pair in stored["model"]["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((vocabulary[a], vocabulary[b], vocabulary[a + b]))
    for name, token in special.items():
        labels[token] = name.encode()
    return labels, merges, special
