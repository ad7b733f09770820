"""Arrow text columns as byte blocks for numpy: whole texts, bounded block sizes.

A block is a run of whole documents of one Arrow batch, cut so that it stays near
``BLOCK_BYTES``; a longer single text forms a block of its own. A null text is empty.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

#: Words of the quality and fingerprint contracts: everything but space and \t..\r.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Words of the decontamination contract after lower-casing: a-z, 0-9 and non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """Bytes of consecutive documents; document i is ``data[off[i]:off[i + 1]]``."""

    data: np.ndarray
    off: np.ndarray

    def __len__(self) -> int:
        return len(self.off) - 1

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per document, the sum of a value per byte."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.off[1:]] - total[self.off[:-1]]

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, position, "right") - 1

    def lowered(self) -> Block:
        return Block(LOWER[self.data], self.off)


@dataclass
class Words:
    """Words of a block: word j is ``block.data[start[j]:end[j]]``; those of document i are first[i]:first[i + 1]."""

    block: Block
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    inside: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.block)), np.diff(self.first))

    @cached_property
    def array(self) -> pa.Array:
        """The words as an Arrow binary array over one contiguous buffer."""
        return binary_array(self.block.data[self.inside], self.end - self.start)

    @cached_property
    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Per word the index of its text in the block's vocabulary, and the vocabulary."""
        d = self.array.dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


def block_of(texts: pa.Array) -> Block:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return Block(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Block(raw[off[0]:off[-1]], off - off[0])


def blocks(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """The batches cut into runs of whole rows of about ``max_bytes`` of text each."""
    for batch in batches:
        whole = block_of(batch.column(column))
        i = 0
        while i < len(whole):
            j = max(i + 1, int(np.searchsorted(whole.off, whole.off[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), Block(whole.data[whole.off[i]:whole.off[j]], whole.off[i:j + 1] - whole.off[i])
            i = j


def words(block: Block, table: np.ndarray) -> Words:
    """Maximal runs of bytes marked in ``table``; a run ends with its document."""
    inside = table[block.data]
    n = len(inside)
    starts, ends = inside.copy(), inside.copy()
    if n:
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        at = block.off[1:-1]
        at = at[(at > 0) & (at < n)]
        starts[at] = inside[at]
        ends[at - 1] = inside[at - 1]
    start = np.flatnonzero(starts)
    return Words(block, start, np.flatnonzero(ends) + 1, np.searchsorted(start, block.off), inside)


def code_points(data: np.ndarray) -> np.ndarray:
    """1 for each byte that begins a UTF-8 code point."""
    return (data & 0xC0) != 0x80


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over unsigned integers; one to one."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def recurring(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once in ``keys``."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys
