"""Benchmark decontamination over a distributed positional inverted index.

The index is a table: one row per (shard, term) with the term's ascending positions in the
shard, as gaps. A shard is a run of whole training texts of bounded size, so a shard's lists fit a
task whatever the corpus, and very frequent terms are split over all shards. Positions leave
a gap of one between texts, so that no phrase runs from one text into the next.

A phrase is looked up shard by shard: its lists are taken from the rarest term on, each
shifted back by the term's offset, and intersected. Test phrases go to the shards in blocks
of bounded size, and only the index rows of a block's terms are read.

Words are the maximal runs of bytes outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after
lower-casing A-Z. Defined results: a null, empty or wordless text has no words, no hits and
is not contaminated; a null, empty or wordless item has no window; an item without an id is
left out, items of the same id count once. Repeated documents and null ids keep their rows.
Empty tables give empty results. Other input columns are not read.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import handover
from segmark.llm.textblocks import ALNUM, BLOCK_BYTES, blocks, words

WINDOW = 13
#: Test phrases sent to the shards at a time; bounds the broadcast whatever the test set's size.
QUERY_BLOCK = 20_000

def build_index(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The written index of ``docs``.

    Term rows have shard, term and gaps (the first position, then differences); document rows have shard, row (a number given
    to the row when the index is written), first (the position of the text's first word),
    n_words and the ``carry`` columns. A shard is named by its first row.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("_text"), *carry)
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.BinaryType()),
        T.StructField("gaps", T.ArrayType(T.IntegerType())), T.StructField("row", T.LongType()),
        T.StructField("first", T.IntegerType()), T.StructField("n_words", T.LongType()),
        *[T.StructField(c, rows.schema[c].dataType) for c in carry]])
    kinds = {"shard": pa.int64(), "term": pa.binary(), "gaps": pa.list_(pa.int32()), "row": pa.int64(),
             "first": pa.int32(), "n_words": pa.int64()}

    def index_rows(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        every = kinds | {c: batch.schema.field(c).type for c in carry}
        n = len(columns["shard"])
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, k) for c, k in every.items()], names=list(every))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "_text", BLOCK_BYTES):
            row = batch.column("row")
            shard = row[0].as_py()
            named = lambda n: pa.array(np.full(n, shard), pa.int64())
            w = words(block.lowered(), ALNUM)
            first = w.first[:-1] + np.arange(len(block))  # the position after each text stays free
            yield index_rows(batch, {
                "shard": named(len(block)), "row": row, "first": pa.array(first, pa.int32()),
                "n_words": pa.array(np.diff(w.first), pa.int64()), **{c: batch.column(c) for c in carry}})
            if len(w):
                code, vocabulary = w.coded
                order = np.argsort(code.astype(np.int32), kind="stable")
                position = (np.arange(len(w)) + w.doc)[order]
                off = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=len(vocabulary)))))
                gap = np.diff(position, prepend=0)
                gap[off[:-1]] = position[off[:-1]]
                yield index_rows(batch, {"shard": named(len(vocabulary)), "term": vocabulary, "gaps": pa.ListArray.from_arrays(
                    pa.array(off, pa.int32()), pa.array(gap, pa.int32()))})

    return handover(rows.mapInArrow(run, schema), "positional-index")


def phrase_positions(lists: dict[bytes, np.ndarray], phrase: list[bytes]) -> np.ndarray:
    """Start positions of an exact phrase: offset-adjusted lists, intersected from the rarest term."""
    found: np.ndarray | None = None
    for j in sorted(range(len(phrase)), key=lambda j: len(lists.get(phrase[j], ()))):
        shifted = np.asarray(lists.get(phrase[j], ()), np.int64) - j
        if found is None:
            found = shifted
        elif len(shifted):
            at = np.minimum(np.searchsorted(shifted, found), len(shifted) - 1)
            found = found[shifted[at] == found]
        if not len(shifted) or not len(found):
            return np.zeros(0, np.int64)
    return np.zeros(0, np.int64) if found is None else found


def proximity_positions(lists: dict[bytes, np.ndarray], terms: list[bytes], within: int) -> np.ndarray:
    """Positions of the rarest of ``terms`` that have every other term at most ``within`` words away.

    The lists are those of one text, or a match may join words of neighbouring texts.
    """
    asked = sorted(set(terms), key=lambda t: len(lists.get(t, ())))
    if not asked or not len(lists.get(asked[0], ())):
        return np.zeros(0, np.int64)
    found = np.asarray(lists[asked[0]], np.int64)
    for t in asked[1:]:
        here = np.asarray(lists[t], np.int64)
        at = np.minimum(np.searchsorted(here, found - within), len(here) - 1)
        found = found[(here[at] >= found - within) & (here[at] <= found + within)]
    return found


def _lists(table: pa.Table) -> dict[bytes, np.ndarray]:
    """Ascending positions per term of one shard's rows."""
    out = {}
    for batch in table.combine_chunks().to_batches():
        gaps = batch.column("gaps")
        off = gaps.offsets.to_numpy().astype(np.int64)
        total = np.concatenate(([0], np.cumsum(gaps.values.to_numpy()[off[0]:off[-1]], dtype=np.int64)))
        off = off - off[0]
        flat = total[1:] - np.repeat(total[off[:-1]], np.diff(off))
        out.update({b: flat[i:j] for b, i, j in zip(batch.column("term").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True)})
    return out


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first position and number of words of a shard's texts, by first position."""
    row, first, n = (table.column(c).to_numpy() for c in ("row", "first", "n_words"))
    order = np.argsort(first, kind="stable")
    return row[order], first[order].astype(np.int64), n[order]


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (item, phrase) of the test items; an item shorter than a window is one phrase."""
    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["item"], T.StructField("phrase", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "_text"):
            w = words(block.lowered(), ALNUM)
            n = np.diff(w.first)
            each = np.where(n > 0, np.maximum(n - window + 1, 1), 0)
            doc = np.repeat(np.arange(len(block)), each)
            begin = w.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.concatenate(([0], np.cumsum(each)))[:-1], each)
            size = np.minimum(n[doc], window)
            off = np.concatenate(([0], np.cumsum(size)))
            at = np.arange(off[-1]) + np.repeat(begin - off[:-1], size)
            phrase = pa.ListArray.from_arrays(pa.array(off, pa.int32()), w.array.take(pa.array(at, pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(doc, pa.int64())), phrase], names=["item", "phrase"])

    return rows.mapInArrow(run, schema).distinct()


def _lookup(shared: Broadcast) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Occurrences of the shared phrases in one shard, per text."""

    def look(lists: pa.Table, texts: pa.Table) -> pa.Table:
        held = _lists(lists)
        row, first, n = _texts(texts)
        start, size, label = [], [], []
        for name, phrase in shared.value:
            if all(t in held for t in phrase):
                at = phrase_positions(held, phrase)
                start.append(at)
                size.append(np.full(len(at), len(phrase)))
                label.append(np.full(len(at), name))
        if not start:
            return _found([], [], [])
        start, size, label = (np.concatenate(x) for x in (start, size, label))
        doc = np.searchsorted(first, start, "right") - 1
        order = np.lexsort((start, doc))
        start, size, label, doc = start[order], size[order], label[order], doc[order]
        out: tuple[list, list, list] = ([], [], [])
        cuts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True]))) if len(doc) else []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            begin = start[i:j] - first[doc[i]]
            upto = np.maximum.accumulate(begin + size[i:j])
            head = np.concatenate(([True], begin[1:] > upto[:-1]))
            tail = np.concatenate((head[1:], [True]))
            out[0].append(int(row[doc[i]]))
            out[1].append([{"start": int(a), "end": int(b)} for a, b in zip(begin[head], upto[tail], strict=True)])
            out[2].append(np.unique(label[i:j]).tolist())
        return _found(*out)

    return look


def find_phrases(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per text with an occurrence and block of phrases: row, spans (word start and end) and labels.

    ``phrases``: phrase (array of terms) and label (long). Spans that overlap or touch are
    merged; labels are the distinct labels of the phrases that occur.
    """
    spark = index.sparkSession
    postings = index.where(F.col("term").isNotNull()).select("shard", "term", "gaps")
    texts = index.where(F.col("row").isNotNull()).select(F.col("shard").alias("home"), "row", "first", "n_words")
    n_blocks = max(1, -(-phrases.count() // QUERY_BLOCK))
    schema = "row long, spans array<struct<start: int, end: int>>, labels array<long>"
    found: list[DataFrame] = []
    for part in range(n_blocks):
        block = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(n_blocks)) == part)
        rows = [(int(r.label), [bytes(t) for t in r.phrase]) for r in block.collect()]  # about QUERY_BLOCK at most
        shared = spark.sparkContext.broadcast(rows)

        terms = F.broadcast(block.select(F.explode("phrase").alias("term")).distinct())  # bounded with the block
        lists = postings.join(terms, "term", "left_semi")
        found.append(lists.groupBy("shard").cogroup(texts.groupBy("home")).applyInArrow(_lookup(shared), schema))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _found(row: list, spans: list, labels: list) -> pa.Table:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.table({"row": pa.array(row, pa.int64()), "spans": pa.array(spans, pa.list_(span)), "labels": pa.array(labels, pa.list_(pa.int64()))})


def find_near(index: DataFrame, terms: list[bytes], within: int) -> DataFrame:
    """(row, word) of the rarest term of each text region that has all ``terms`` within ``within`` words."""
    asked = [bytes(t) for t in terms]
    postings = index.where(F.col("term").isin([bytearray(t) for t in asked])).select("shard", "term", "gaps")
    texts = index.where(F.col("row").isNotNull()).select(F.col("shard").alias("home"), "row", "first", "n_words")

    def look(lists: pa.Table, texts: pa.Table) -> pa.Table:
        held = _lists(lists)
        row, first, n = _texts(texts)
        rows, at = [], []
        for i in range(len(row)) if all(t in held for t in asked) else ():
            own = {t: held[t][slice(*np.searchsorted(held[t], (first[i], first[i] + n[i])))] for t in asked}
            if all(len(p) for p in own.values()):
                found = proximity_positions(own, asked, within) - first[i]
                rows += [int(row[i])] * len(found)
                at += found.tolist()
        return pa.table({"row": pa.array(rows, pa.int64()), "word": pa.array(at, pa.int64())})

    return postings.groupBy("shard").cogroup(texts.groupBy("home")).applyInArrow(look, "row long, word long")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, mark (hash of its text), n_words, n_hit, items, contaminated.

    A word is hit if it lies inside an occurrence of any item's window; ``items`` are the ids
    of the items with an occurring window, as sorted strings. Contaminated: at least one
    word is hit and hits are a twentieth of the words or more.
    """
    marked = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"),
                         F.col(text_col).alias("text"))
    index = build_index(marked, "text", ("id", "mark"))
    windows = windows_of(items, item_id_col, item_text_col, window).select(F.col("item").cast("string").alias("item"), "phrase")
    owned = windows.distinct().groupBy("phrase").agg(F.sort_array(F.collect_set("item")).alias("items"))
    sets = handover(owned.select("items").distinct().withColumn("label", F.monotonically_increasing_id()), "test-sets")
    phrases = handover(owned.join(sets, "items").select("phrase", "label"), "test-phrases")
    found = handover(find_phrases(index, phrases), "found-phrases")
    spans = found.select("row", F.explode("spans").alias("s")).select("row", "s.start", "s.end")
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    n_hit = spans.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    hit_items = found.select("row", F.explode("labels").alias("label")).distinct().join(sets, "label").select(
        "row", F.explode("items").alias("item")).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    texts = index.where(F.col("row").isNotNull()).select("row", "id", "mark", "n_words")
    hits = F.coalesce("n_hit", F.lit(0)).cast("long")
    return texts.join(n_hit, "row", "left").join(hit_items, "row", "left").select(
        F.col("id").alias(id_col), "mark", "n_words", hits.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hits > 0) & (20 * hits >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    bad = contamination(docs, items, id_col, text_col).where("contaminated").select(
        F.col(id_col).alias("_id"), F.col("mark").alias("_mark")).distinct()
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_id"]) & (mark == bad["_mark"]), "left_anti")
