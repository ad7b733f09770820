"""Quality rules: repetition coverage of a text by rolling hashes of several n-gram lengths.

Words become 64-bit values; the hash of an n-word window is a polynomial in them, mixed with
the document. Windows whose hash recurs inside their document mark their words, and the
characters of marked words, over all word characters, are that length's coverage. Lines are
compared as whole byte strings. The pass is a map over whole texts: no shuffle, memory
bounded by a block (or the longest text).

Defined results: null, empty or blank text has no words, fails the base rule (fewer than 50
words) and is not kept. Repeated rows keep their rows. Input columns named like a result
column are replaced. An empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from segmark.llm.common import without
from segmark.llm.textblocks import NOT_SPACE, Block, Words, binary_array, blocks, code_points, recurring, scrambled, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Largest share (percent of word characters) inside n-word windows found twice or more.
MAX_WINDOW_PCT = {5: 45, 7: 40, 10: 35}
#: Largest share (percent of word characters) in lines equal to an earlier line.
MAX_LINE_PCT = 30

_BASE = np.uint64(0x9DDFEA08EB382D69)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def covered_words(w: Words, value: np.ndarray, n: int) -> np.ndarray:
    """True for words inside an n-word window that occurs twice or more in their document."""
    m = len(w) - n + 1
    mark = np.zeros(len(w) + 1, np.int32)
    if m <= 0:
        return mark[:-1] > 0
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * _BASE + value[i:i + m]
    inside = w.doc[:m] == w.doc[n - 1:]
    at = np.flatnonzero(inside)
    hit = at[recurring(scrambled(h[at] ^ scrambled(w.doc[at])))]
    mark[hit] += 1
    mark[hit + n] -= 1
    return np.cumsum(mark[:-1]) > 0


def repeated_lines(block: Block, w: Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word that equal an earlier line, and their word characters."""
    newline = block.data == 0x0A
    breaks = np.flatnonzero(newline)
    doc = block.doc_of(breaks)
    start = np.sort(np.concatenate((block.off[:-1], breaks + 1)), kind="stable")
    end = np.sort(np.concatenate((block.off[1:], breaks)), kind="stable")
    doc = np.sort(np.concatenate((np.arange(len(block)), doc)), kind="stable")
    first, last = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    line = binary_array(block.data[~newline], end - start).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    at = np.flatnonzero(last > first)
    order = at[np.lexsort((at, line[at], doc[at]))]
    again = np.zeros(len(order), bool)
    again[1:] = (line[order[1:]] == line[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    hit = order[again]
    total = np.concatenate(([0], np.cumsum(chars)))
    n = np.bincount(doc[hit], minlength=len(block))
    c = np.bincount(doc[hit], weights=total[last[hit]] - total[first[hit]], minlength=len(block))
    return n.astype(np.int64), c.astype(np.int64)


def measure(block: Block, lengths: tuple[int, ...] = tuple(MAX_WINDOW_PCT)) -> dict[str, np.ndarray]:
    """All counts of the documents of a block."""
    w = words(block, NOT_SPACE)
    point = code_points(block.data)
    upto = np.concatenate(([0], np.cumsum(point, dtype=np.int64)))
    chars = upto[w.end] - upto[w.start]
    value = scrambled(w.coded[0])
    per_doc = lambda x: np.bincount(w.doc, weights=x, minlength=len(block)).astype(np.int64)
    n_dup, dup_chars = repeated_lines(block, w, chars)
    out = {
        "n_words": np.diff(w.first),
        "word_chars": per_doc(chars),
        "n_symbols": block.sums(SYMBOLS[block.data]),
        "n_dup_lines": n_dup,
        "n_repeat_words": per_doc(covered_words(w, value, 3)),
        "dup_line_chars": dup_chars,
    }
    for n in lengths:
        out[f"dup_{n}_chars"] = per_doc(chars * covered_words(w, value, n))
    return out


def judge(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"])
    kept = ~failed & (100 * m["dup_line_chars"] <= MAX_LINE_PCT * m["word_chars"])
    for n, most in MAX_WINDOW_PCT.items():
        kept &= 100 * m[f"dup_{n}_chars"] <= most * m["word_chars"]
    return failed, kept


def repetition(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus the counts, ``base_failed`` and ``kept`` of every whole text."""
    longs = [*COUNTS, *[f"dup_{n}_chars" for n in MAX_WINDOW_PCT]]
    rows = without(df, {*longs, "base_failed", "kept"} - {text_col.lower()})
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in longs],
                           T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, text_col):
            m = measure(block)
            failed, kept = judge(m)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(m[c], pa.int64()) for c in longs], pa.array(failed), pa.array(kept)],
                names=[*batch.schema.names, *longs, "base_failed", "kept"])

    return rows.mapInArrow(run, schema)
