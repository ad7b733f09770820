"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokenising is a map over whole texts. Texts split at ASCII blanks, which the tokenizer
drops and never joins across, and between ASCII letters and digits or marks, which it never
joins. Only the distinct words of a block (minus those a bounded cache knows) pass through
the tokenizer; ids are then gathered by numpy.

Packing is vector best-fit: a bin has residual tokens, documents and attention cost (the sum
of squared piece lengths); pieces go, longest first, to the open bin that fits in every
dimension and scores best by weighted residual norm or weighted dot product. Pieces are
dealt to groups of bounded expected size by a hash of a written row number, whatever their
ids, and each group packs on its own, so no key can crowd a task; a group wastes a fraction
of a sequence. Full-length pieces are sequences already and skip the shuffle.

Defined results: null and empty texts are one piece holding the end id alone. Repeated rows
and null ids are packed row by row. An empty table gives an empty result.
"""
from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import handover
from segmark.llm.textblocks import Block, Words, blocks, words

#: Blanks at which a text may be cut without changing its tokens.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[list(b" \t\n\r")] = False

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"0123456789!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True  # not ' (contractions) nor <|> (special tokens)

GROUP_PIECES = 4096
CACHE_ENTRIES = 500_000


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence and the weight of each dimension in the choice of a bin."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02)
    rule: str = "norm"  # or "dot"

    def __post_init__(self) -> None:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {self.rule!r}")
        if min(self.tokens, self.documents, self.attention) < 1 or self.tokens**2 > self.attention:
            raise ValueError("a full piece must fit into an empty sequence")


def _cut_points(w: Words) -> Words:
    """``w`` cut further between an ASCII letter and a digit or mark, where no token runs on."""
    d = w.block.data
    at = np.flatnonzero(w.inside[1:] & w.inside[:-1] & ((_LETTER[d[:-1]] & _MARK[d[1:]]) | (_MARK[d[:-1]] & _LETTER[d[1:]]))) + 1
    at = at[~np.isin(at, w.block.off)]
    start = np.sort(np.concatenate((w.start, at)), kind="stable")
    return Words(w.block, start, np.sort(np.concatenate((w.end, at)), kind="stable"), np.searchsorted(start, w.block.off), w.inside)


#: The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _plain(word: bytes) -> str:
    """A word of lower-case Latin letters in the byte-level alphabet, or an empty string for any other."""
    if word.isascii():
        return word.decode() if word.isalpha() and word.islower() else ""
    s = word.decode()
    if not s.isalpha() or max(s) > "\u00ff":
        return ""
    return s.lower().encode().decode("latin-1").translate(_BYTE_LEVEL)


def _has_special(data: np.ndarray) -> bool:
    """Whether a special token may be in the text; those match in their own letter case alone."""
    return bool((((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any()))


class TextEncoder:
    """Ids of whole texts with ``end_id`` after each; each distinct word of a block is encoded once.

    Words are handed over many at a time, joined by a special token of the tokenizer: it
    splits the text before anything else happens, and shows where a word's ids end.
    """

    def __init__(self, tokenizer_json: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.end_id = end_id
        special = {i: t for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)}
        # Words of a-z reach the model directly if the tokenizer lower-cases, and takes runs of letters whole.
        config = json.loads(tokenizer_json)
        steps = config["normalizer"] or {}
        kinds = {s["type"] for s in steps.get("normalizers", [steps])}
        self.lowers = kinds == {"NFC", "Replace", "Lowercase"}
        split = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.plain = self.lowers and [s["type"] for s in split] == ["Split", "ByteLevel"] and "|[\\p{L}]+|" in split[0]["pattern"].get("Regex", "")
        self.mark_id, self.mark = next(((i, t.content) for i, t in sorted(special.items())), (-1, ""))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _encode(self, texts: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` and how many each has; kind 0: in the byte-level alphabet, 2: with special tokens."""
        if kind == 0:
            model = self.tokenizer.model
            found = [[token.id for token in model.tokenize(v)] for v in texts]
            return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))
        if not self.mark or kind == 2:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))
        joined = [self.mark.join([*texts[i:i + 1024], ""]) for i in range(0, len(texts), 1024)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self.mark_id)
        return ids[ids != self.mark_id], np.diff(ends, prepend=-1) - 1

    def _learn(self, vocabulary: list[bytes]) -> np.ndarray:
        """Index of each word in the cache."""
        new = [v for v in vocabulary if v not in self.known]
        if new and len(self.known) + len(new) > CACHE_ENTRIES:
            self._forget()
            new = vocabulary
        if new:
            mark = self.mark.encode()
            plain = [_plain(v) if self.plain else "" for v in new]
            kind = [0 if s else 2 if mark and mark in v else 1 for v, s in zip(new, plain, strict=True)]
            for k in range(3):
                if part := [v for v, own in zip(new, kind, strict=True) if own == k]:
                    ids, n = self._encode([s for s in plain if s] if k == 0 else [v.decode() for v in part], k)
                    self.known.update(zip(part, range(len(self.size), len(self.size) + len(part)), strict=True))
                    self.flat, self.size = np.concatenate((self.flat, ids)), np.concatenate((self.size, n))
        return np.fromiter(map(self.known.__getitem__, vocabulary), np.int64, len(vocabulary))

    def ids(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block and the offsets of its documents in them."""
        if self.lowers and not _has_special(block.data):
            block = block.lowered()
        w = _cut_points(words(block, NOT_BLANK))
        code, vocabulary = w.coded
        index = self._learn(vocabulary.to_pylist())[code] if len(code) else np.zeros(0, np.int64)
        begin = np.concatenate(([0], np.cumsum(self.size)))
        n = self.size[index]
        upto = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(upto[-1]) + np.repeat(begin[index] - upto[:-1], n)
        off = upto[w.first] + np.arange(len(block) + 1)  # one end id per document
        out = np.full(int(off[-1]), self.end_id, "<u4")
        mark = np.ones(len(out), bool)
        mark[off[1:] - 1] = False
        out[mark] = self.flat[at]
        return out, off


def token_pieces(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32 and, if asked, the ids themselves."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # a fixed vocabulary file of a few MB
    rows = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    fields = [rows.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value, end_id)
        for batch, block in blocks(batches, "_text"):
            ids, off = encoder.ids(block)
            n = -(-np.diff(off) // length)
            doc = np.repeat(np.arange(len(block)), n)
            piece = np.arange(len(doc)) - np.repeat(np.concatenate(([0], np.cumsum(n)))[:-1], n)
            start = piece * length
            begin = off[doc] + start
            end = np.minimum(begin + length, off[doc + 1])
            crc = [zlib.crc32(ids[i:j]) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]
            cols = [batch.column(id_col).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(end - begin, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def best_fit(length: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins. Deterministic for a given order."""
    most = np.array([cap.tokens, cap.documents, cap.attention], float)
    weight = np.array(cap.weights)[:, None]
    room = np.empty((3, len(length)))
    label = np.empty(len(length), np.int64)
    bin_of = np.empty(len(length), np.int64)
    offset = np.empty(len(length), np.int64)
    open_, made = 0, 0
    least = int(length.min()) if len(length) else 0
    for i in np.argsort(-length, kind="stable"):
        need = np.array([length[i], 1, length[i] ** 2], float)
        left = room[:, :open_] - need[:, None]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            if cap.rule == "norm":
                score = (weight * (left / most[:, None]) ** 2).sum(axis=0)
            else:
                score = -(weight * (room[:, :open_] / most[:, None]) * (need / most)[:, None]).sum(axis=0)
            b = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            b, open_ = open_, open_ + 1
            room[:, b], label[b], made = most, made, made + 1
        bin_of[i], offset[i] = label[b], cap.tokens - int(room[0, b])
        room[:, b] -= need
        if room[0, b] < least or room[1, b] < 1 or room[2, b] < least * least:  # nothing fits any more
            open_ -= 1
            room[:, b], label[b] = room[:, open_], label[open_]
    return bin_of, offset, made


def pack(pieces: DataFrame, cap: Capacity = Capacity(), group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a ``length`` column) plus sequence_id and offset.

    Sequence ids are unique, not dense: the group and the bin in it, or the row number of a
    full piece below zero.
    """
    numbered = handover(pieces.withColumn("_row", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") >= cap.tokens
    out = [F.col(f"`{c}`") for c in pieces.columns]
    alone = numbered.where(full).select(*out, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = numbered.where(~full)
    groups = max(1, math.ceil(rest.count() / group_pieces))
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", kind="stable")
        bin_of, offset, _ = best_fit(pdf["length"].to_numpy(np.int64), cap)
        return pdf.assign(sequence_id=(pdf["_group"].to_numpy(np.int64) << 32) + bin_of, offset=offset)[schema.names]

    return alone.unionByName(dealt.groupBy("_group").applyInPandas(run, schema))


def pack_documents(df: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
                   cap: Capacity = Capacity(), end_id: int = 0, with_ids: bool = False) -> DataFrame:
    return pack(token_pieces(df, tokenizer_json, id_col, text_col, cap.tokens, end_id, with_ids), cap)
