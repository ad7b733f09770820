"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their beginnings of 3 to 8 bytes (inflected forms share
them), hashed into ``SPACE`` cells. The machine has a weight per cell and a vector of
``FACTORS`` numbers whose dot products weigh pairs of cells, so a pair can count for more than
the sum of its parts.

The model is fitted on a bounded sample, about ``SAMPLE_ROWS`` labelled rows spread by a hash
of their ids, of the rows that are not held out. Cells are picked in Spark, for two reasons: the
``MAX_CELLS`` whose share among toxic and other texts differs most, by the z value of the log odds;
and, whatever their labels, the cells of the ``MAX_WORDS`` words that divide the sample most evenly,
so that a word that matters only beside another reaches the machine. Scoring is a map over whole texts.

Defined results: a null or wordless text scores as one without any term. Without labelled
training rows, or with labels of one class, every score is the smoothed base rate (0.5
without any row). Null labels teach nothing; of several labels of an id the largest counts.
Repeated rows and null ids keep their rows; a null id has no label. Input columns named like
a result column are replaced.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import handover, without
from segmark.llm.langid import held_out
from segmark.llm.textblocks import ALNUM, Block, blocks, scrambled, words

SPACE = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
SAMPLE_ROWS = 20_000
MAX_CELLS = 2048
MAX_WORDS = 4096
MIN_Z = 3.0
FIT_BYTES = 1 << 20  # of text at a time while all cells of a text are at hand
MIN_ROWS = 5
FACTORS = 8
EPOCHS = 16
#: Weight of a toxic row in the loss: a missed one counts for more than a false alarm.
TOXIC_WEIGHT = 2.0

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _cells_of_words(vocabulary: pa.Array) -> np.ndarray:
    """Hash cells of each word and of its beginnings; -1 where the word is no longer than one."""
    off = np.frombuffer(vocabulary.buffers()[1], np.int32)[:len(vocabulary) + 1].astype(np.int64)
    size = np.diff(off)
    byte = scrambled(np.frombuffer(vocabulary.buffers()[2], np.uint8)[:off[-1]])
    place = np.arange(len(byte)) - np.repeat(off[:-1], size)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()) + 1, _STEP))
        whole = np.add.reduceat(byte * power[place], off[:-1])
        out = [scrambled(whole) & np.uint64(SPACE - 1)]
        start = np.zeros(len(size), np.uint64)
        for k in range(max(PREFIXES)):
            start += np.where(size > k, byte[np.minimum(off[:-1] + k, len(byte) - 1)] * power[min(k, len(power) - 1)], np.uint64(0))
            if k + 1 in PREFIXES:
                out.append(np.where(size > k + 1, scrambled(start + np.uint64(k)) & np.uint64(SPACE - 1), np.uint64(SPACE)))
    cells = np.stack(out, axis=1).astype(np.int64)
    return np.where(cells < SPACE, cells, -1)


def text_cells(block: Block, chosen: np.ndarray | None = None, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(document, cell) of the distinct terms of each text, sorted; with ``chosen`` (cell to
    column, or -1) only those, as columns; with ``whole`` only whole words."""
    w = words(block.lowered(), ALNUM)
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, vocabulary = w.coded
    cells = _cells_of_words(vocabulary)[:, :1] if whole else _cells_of_words(vocabulary)
    if chosen is not None:
        cells = np.where(cells >= 0, chosen[cells], -1)
    held = cells >= 0
    n = held.sum(axis=1)
    flat, begin = cells[held], np.concatenate(([0], np.cumsum(n)))
    pair = np.unique((w.doc * len(vocabulary) + code)[n[code] > 0])  # each distinct word of a text once
    doc, code = pair // len(vocabulary), pair % len(vocabulary)
    size = n[code]
    at = np.arange(size.sum()) + np.repeat(begin[code] - np.concatenate(([0], np.cumsum(size)))[:-1], size)
    key = np.unique(np.repeat(doc, size) * SPACE + flat[at])
    return key // SPACE, key % SPACE


@dataclass
class FactorizationMachine:
    chosen: np.ndarray  # cell to column, or -1
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def scores(self, block: Block) -> np.ndarray:
        doc, column = text_cells(block, self.chosen)
        n = len(block)
        z = self.bias + np.bincount(doc, weights=self.weight[column], minlength=n) if len(doc) else np.full(n, self.bias)
        if len(doc):
            for f in range(self.factors.shape[1]):
                v = self.factors[column, f]
                z = z + 0.5 * (np.bincount(doc, weights=v, minlength=n) ** 2 - np.bincount(doc, weights=v * v, minlength=n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """0/1 rows by the columns that are set; a batch of them is made dense when it is its turn."""

    def __init__(self, off: np.ndarray, column: np.ndarray, width: int) -> None:
        self.off, self.column, self.shape = off, column, (len(off) - 1, width)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        size = self.off[rows + 1] - self.off[rows]
        at = np.arange(size.sum()) + np.repeat(self.off[rows] - np.concatenate(([0], np.cumsum(size)))[:-1], size)
        out = np.zeros((len(rows), self.shape[1]), np.float32)
        out[np.repeat(np.arange(len(rows)), size), self.column[at]] = 1
        return out


def train(x: np.ndarray | Rows, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by mini-batch Adagrad on the logistic loss; x: rows by columns, 0 or 1."""
    rng = np.random.default_rng(7)
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    w = np.zeros(x.shape[1])
    v = rng.normal(0, 0.01, (x.shape[1], FACTORS))
    seen = [np.full_like(w, 1e-6), np.full_like(v, 1e-2), np.full(1, 1e-2)]
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 256):
            rows = order[i:i + 256]
            b = x[rows].astype(np.float32)
            s = b @ v
            z = bias + b @ w + 0.5 * (s**2 - b @ (v * v)).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * np.where(y[rows] > 0, TOXIC_WEIGHT, 1.0) / len(rows)
            gw = b.T @ e + decay * w / 10
            gv = b.T @ (e[:, None] * s) - v * (b.T @ e)[:, None] + decay * v
            gb = np.array([e.sum()])
            for held, g in zip(seen, (gw, gv, gb), strict=True):
                held += g * g
            w -= rate * gw / np.sqrt(seen[0])
            v -= 0.5 * rate * gv / np.sqrt(seen[1])
            bias -= float(rate * gb[0] / np.sqrt(seen[2][0]))
    return bias, w, v


def _cell_counts(sample: DataFrame) -> DataFrame:
    """(cell, word, pos, neg): toxic and other sample texts with a term in the cell; apart, with a whole word in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, 2, SPACE), np.int64)
        for batch, block in blocks(batches, "_text", FIT_BYTES):
            label = batch.column("_label").to_numpy(zero_copy_only=False).astype(np.int64)
            for whole in (0, 1):
                doc, cell = text_cells(block, whole=bool(whole))
                for y in (0, 1):
                    count[whole, y] += np.bincount(cell[label[doc] == y], minlength=SPACE)
        for whole in (0, 1):
            cell = np.flatnonzero(count[whole].any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.full(len(cell), bool(whole))), pa.array(count[whole, 1, cell]),
                                              pa.array(count[whole, 0, cell])], names=["cell", "word", "pos", "neg"])

    counted = sample.mapInArrow(run, "cell long, word boolean, pos long, neg long")
    return counted.groupBy("cell", "word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _columns(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(label, columns) of each sample text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "_text", FIT_BYTES):
            doc, column = text_cells(block, chosen)
            off = np.searchsorted(doc, np.arange(len(block) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(column, pa.int32()))], names=["label", "columns"])

    return sample.mapInArrow(run, "label int, columns array<int>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """A machine fitted on about ``sample_rows`` labelled rows of ``docs`` that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("_label")).where(~held_out("_id"))
    total = known.count()
    spread = 1 << 20
    taken = known.where(F.pmod(F.xxhash64("_id"), F.lit(spread)) < int(spread * min(1.0, sample_rows / max(total, 1))))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sample = handover(texts.join(taken, "_id").select("_text", F.col("_label").cast("int").alias("_label")), "toxicity-sample")
    sizes = {r._label: r.n for r in sample.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    chosen = np.full(SPACE, -1, np.int64)
    share = (n_pos + 0.5) / (n_pos + n_neg + 1)
    if not n_pos or not n_neg:
        return FactorizationMachine(chosen, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
    c, d = F.lit(n_pos + 1.0) - a, F.lit(n_neg + 1.0) - b
    z = F.abs(F.log(a * d / (b * c))) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    counts = handover(_cell_counts(sample).where(F.col("pos") + F.col("neg") >= MIN_ROWS), "toxicity-cells")
    telling = counts.where(~F.col("word")).select("cell", z.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "cell").limit(MAX_CELLS)
    n = F.col("pos") + F.col("neg")
    even = F.least(n, F.lit(n_pos + n_neg) - n)
    dividing = counts.where(F.col("word") & (even >= MIN_ROWS)).orderBy(F.desc(even), "cell").limit(MAX_WORDS)
    cells = np.unique(np.array([r.cell for r in telling.select("cell").union(dividing.select("cell")).collect()], np.int64))
    chosen[cells] = np.arange(len(cells))
    rows = _columns(sample, chosen).toArrow()  # the bounded sample, at most MAX_CELLS + MAX_WORDS small numbers a row
    found = rows.column("columns").combine_chunks()
    x = Rows(np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy()))), found.flatten().to_numpy(), len(cells))
    label = rows.column("label").to_numpy().astype(float)
    bias, w, v = train(x, label)
    return FactorizationMachine(chosen, bias, w, v)


def score_toxicity(df: DataFrame, model: FactorizationMachine, text_col: str = "text") -> DataFrame:
    """``df`` plus score (0 to 1) and predicted (1 from a score of 0.5 on)."""
    rows = without(df, {"score", "predicted"} - {text_col.lower()})
    shared = df.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays: workers need not import this module
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = FactorizationMachine(**shared.value)
        for batch, block in blocks(batches, text_col):
            s = own.scores(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*batch.schema.names, "score", "predicted"])

    return rows.mapInArrow(run, schema)
