"""Words of whole Arrow batches at once: one pass over the batch's bytes, then work on distinct words only."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def byte_table(keep: Callable[[int], bool]) -> bytes:
    """Translation of UTF-8 bytes: A-Z to a-z, bytes that aren't kept to a space. Bytes from 128 on are never touched."""
    lowered = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if b >= 128 or keep(b) else 32 for b in lowered)


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """``texts`` with every byte mapped; only bytes below 128 may change, so offsets and UTF-8 stay valid. Nulls become empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    data = texts.buffers()[2]
    moved = pa.py_buffer(data.to_pybytes().translate(table) if data else b"")
    return pa.LargeStringArray.from_buffers(len(texts), texts.buffers()[1], moved, None, 0, texts.offset)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in order, split at ASCII white space, and the row each belongs to."""
    lists = pc.ascii_split_whitespace(texts)
    words, rows = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    there = pc.greater(pc.binary_length(words), 0)
    return words.filter(there), rows[there.to_numpy(zero_copy_only=False)]


def listed(words: pa.Array) -> list[str]:
    """``words``, which hold no line feed and aren't empty, as Python strings, made by one split."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())), "\n")[0].as_py().split("\n") if len(words) else []


def crc32_of(words: pa.Array) -> np.ndarray:
    """Unsigned crc32 of the UTF-8 bytes of each word; distinct words are hashed once."""
    coded = words.dictionary_encode()
    each = np.fromiter(map(zlib.crc32, map(str.encode, listed(coded.dictionary))), np.uint32, len(coded.dictionary))
    return each[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint32)
