"""Documents with every odd case, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

BLANK = r"[\x20\x09-\x0D]+"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, part int, row string, stats string, "
    "norm string, run long, shard int, print long, one long"
)


def prose(seed, count, letters="abcdeé"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(1, 7))) for _ in range(count))


def texts():
    long = "\n".join(prose(seed, 40) for seed in range(60))
    copied = prose(900, 60) + "\n" + prose(901, 30) + "\n" + prose(902, 20)
    found = [
        None, "", " ", "\n\n", "one", "two words", "  leading", "trailing ", "tab\there\x0bthere\x0c.", "a  b   c",
        "<|endoftext|> and <|startoftext|>", "don't we'll I'M", "\x00 null", "中文 字符 😀", "İstanbul ΣΑΣ", "▁ sign ▁▁",
        "x" * 3000, " no　break", "é ́", long, long, long + " ", long.replace("\n", "\n\n"), copied,
        copied.upper(), "start\n" + copied, prose(5, 30) + "\n" + copied + "\n" + prose(6, 30), "spam " * 400, "Q! " * 300,
        "word *** $$$ ### " * 50, "1 22 333 4444 " * 40, "\r\n".join(["same line here"] * 30),
    ]
    found += [prose(seed, 5 + seed % 200) for seed in range(100, 160)]
    found += [prose(200, 120).replace("a", "a", 1) + f" {word}" for word in ("x", "y", "z")]
    return found


def rows():
    """Ids in no order, one missing, one row twice, one id with two texts."""
    found = [(3 * place + 1, text) for place, text in enumerate(texts())]
    random.Random(3).shuffle(found)
    found += [(None, "no id"), (7, found[0][1]), found[1], found[1]]
    filler = ("xx", "src", 1, 9, "r", "s", "n", 5, 6, 8, 10)
    return [(doc_id, text, *filler) for doc_id, text in found]


VECTORS = "vec_id long, embedding array<float>, label int, key long, block long, anchor long"


def vectors():
    """Vectors with missing and undefined parts, copies, ties, ids that repeat, and lengths that differ."""
    draw = random.Random(11)
    found = [(at, [draw.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(6)], at % 3) for at in range(420)]
    found += [(1000 + at, [0.5, 0.5, 0.5, 0.5, 0.25, at % 2 / 256], 1 if at % 4 else 2) for at in range(300)]
    found += [(50, None, 1), (100, [0.5, None, 0.5], 1), (150, [float("nan")] * 6, 1), (200, [float("inf")] * 6, 2)]
    found += [(250, [0.5] * 6, None), (None, [1.0] * 6, 1), (300, [0.5] * 6, 0), (300, [0.5] * 6, 0), (300, [-0.5] * 6, 1)]
    found += [(350, [], 1), (400, [0.75], 2), (450, [0.001, -0.001, 0.3, 0.7, 0.1, 0.9, 0.4], 2), (500, [0.0] * 6, 2)]
    return [(*row, 1, 2, 3) for row in found]


def words(text):
    return [word for word in re.split(BLANK, text or "") if word]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def statistics(text):
    found = words(text)
    windows = [tuple(found[at : at + 8]) for at in range(len(found) - 7)]
    times = Counter(windows)
    covered = {at + step for at, window in enumerate(windows) if times[window] > 1 for step in range(8)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(character in "#*$%&|<>" for character in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def many(found):
    """Rows as a multiset."""
    return Counter(found)
