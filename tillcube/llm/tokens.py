"""Token ids of whole texts inside Spark tasks."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the machine that runs the task."""
    return public_tokenizers.path(name)


def checksums(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each slice of ids as little-endian unsigned 32-bit numbers."""
    data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    cuts = (ends * 4).tolist()
    return np.fromiter(
        (zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), np.int64, len(cuts) - 1
    )


def with_end(ids: np.ndarray, begin: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each closed by ``end_id``."""
    return np.insert(ids, begin[1:], end_id), begin + np.arange(len(begin))
