"""Byte-aligned variable-length numbers with separate control bytes.

A number takes one to four bytes, least first. Each control byte holds the
lengths of four numbers, two bits each. Both directions work on whole arrays; the
lengths and masks of a control byte come from tables of 256 rows.
"""

from __future__ import annotations

import numpy as np

#: For each control byte the lengths of its four numbers.
LENGTHS = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.int64)
#: For each control byte the bits of four bytes that belong to each number.
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)[LENGTHS - 1]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = np.ascontiguousarray(values, "<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    filled = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    filled[: len(values)] = code
    control = (filled.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control, data


def decode(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` numbers."""
    length = LENGTHS[control].reshape(-1)[:n]
    end = np.cumsum(length)
    if n and end[-1] != len(data):
        raise ValueError("data bytes and control bytes do not agree")
    padded = np.concatenate((data, np.zeros(3, np.uint8)))
    four = np.lib.stride_tricks.sliding_window_view(padded, 4)[end - length] if n else np.zeros((0, 4), np.uint8)
    return np.ascontiguousarray(four).view("<u4").reshape(-1) & MASKS[control].reshape(-1)[:n]


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, most frequent first (ties to smaller ids), and each id's place there."""
    count = np.bincount(ids)
    table = np.flatnonzero(count)
    table = table[np.argsort(-count[table], kind="stable")]
    place = np.zeros(len(count), np.uint32)
    place[table] = np.arange(len(table), dtype=np.uint32)
    return table.astype(np.uint32), place[ids]
