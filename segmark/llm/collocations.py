"""Phrase collocations by SON partitioning: mine shards completely, then count the candidates exactly.

Documents are dealt into ``SHARDS`` shards by a hash of id and text. A phrase of global support s
must reach ``ceil(s * n_shard / n)`` in at least one shard (n: words of its language there and in
all), so what is frequent in no shard is frequent nowhere.

1. Each shard is mined level by level over phrases of 1 to ``MAX_WORDS`` words, as one aggregate per
   level over all shards: (shard and language, word or key of the phrase) with counts from the tasks.
   A phrase is counted if both of its shorter ends may be frequent in its shard; that is looked up in
   a bitmap of ``BITS`` bits, which may say yes too often but never no too often.
2. The locally frequent phrases of all shards form one bitmap of candidates.
3. One more pass counts the candidates by their language and text (words have been counted so in
   step 1): hash keys decide which phrases are counted, never a count.

The rest are joins and aggregates over the frequent phrases: the weakest cut of each, phrases that
live inside a longer one, and the first ``TOP`` of each language.

The bitmaps and the number of shards are fixed; with more phrases than bits the bitmaps let more
phrases through to the count, and results stay the same. Phrases never cross documents. Very long
texts are read in chunks that overlap by ``MAX_WORDS`` - 1 words.

Defined results: a null text has no words; a null language is ``und``. Repeated rows count as often
as they occur; ids only deal rows to shards and may be null. A language without a frequent phrase
gives no rows. Empty tables give empty results. Other input columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmark.llm.common import handover, release
from segmark.llm.textblocks import Block, block_of, blocks, scrambled, words

SHARDS = 4
SUPPORT = 30
MAX_WORDS = 4
BITS = 25
TOP = 2000
TEXT_BYTES = 2 << 20  # of text at a time in a task
INSIDE_PERCENT = 80
SCORE_UNIT = 2_000_000

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~SEPARATOR
WORD[[0x20, 0x09]] = False

_STEP = 0xD6E8FEB86659FD93
_BYTE = scrambled(np.arange(1, 257))
#: Low bits of a key that make room for a small number while keys are sorted.
_LOW = 6


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, the same wherever the bytes stand."""
    n = len(data)
    power = np.full(n + 1, _STEP, np.uint64)
    power[0] = 1
    with np.errstate(over="ignore"):
        np.cumprod(power, out=power)
        total = np.zeros(n + 1, np.uint64)
        np.multiply(_BYTE[data], power[:n], out=total[1:])
        np.cumsum(total, out=total)
        power[1:] = pow(_STEP, -1, 1 << 64)  # from here on the inverse powers
        power[0] = 1
        np.cumprod(power, out=power)
        return scrambled((total[end] - total[start]) * power[start])


class Text:
    """Words of a block: hashes, documents, and which word is followed by one of its piece.

    ``own`` is False for words that are there only to complete phrases of the words before them.
    """

    def __init__(self, block: Block, limit: int | None = None) -> None:
        self.words = w = words(block.lowered(), WORD)
        self.doc = w.doc
        self.own = np.ones(len(w), bool) if limit is None else w.start < limit
        self.hash = word_hashes(w.block.data, w.start, w.end)
        piece = np.cumsum(SEPARATOR[block.data].view(np.uint8), dtype=np.int32)[w.start]
        self.joined = np.zeros(len(w), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length the first words of its phrases and the phrases' hashes."""
        at, h = np.arange(len(self.hash)), self.hash
        yield 1, at, h
        for k in range(2, longest + 1):
            go = self.joined[at + k - 2]
            at = at[go]
            with np.errstate(over="ignore"):
                h = scrambled(h[go] * np.uint64(_STEP) + self.hash[at + k - 1])
            yield k, at, h


def _chunks(block: Block) -> Iterator[tuple[Block, int | None]]:
    """The block, or chunks of its one long text that begin at words and overlap by MAX_WORDS - 1 words."""
    n = len(block.data)
    if len(block) > 1 or n <= 2 * TEXT_BYTES:
        yield block, None
        return
    at = 0
    while at < n:
        limit = stop = min(n, at + TEXT_BYTES)
        while limit < n and WORD[block.data[limit - 1]]:  # to the end of the word
            ahead = np.flatnonzero(~WORD[block.data[limit:limit + 4096]])
            limit = min(n, limit + (int(ahead[0]) + 1 if len(ahead) else 4096))
        stop, more = limit, MAX_WORDS - 1
        while stop < n and more:
            part = WORD[block.data[stop - 1:stop + 65536]]
            ends = np.flatnonzero(part[:-1] & ~part[1:])
            if len(ends) >= more:
                stop, more = stop + int(ends[more - 1]) + 1, 0
            else:
                more -= len(ends)
                stop = min(n, stop + len(part) - 1)
        yield Block(block.data[at:stop], np.array([0, stop - at])), limit - at
        at = limit


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Text]]:
    for batch, block in blocks(batches, "text", TEXT_BYTES):
        for chunk, limit in _chunks(block):
            yield batch, Text(chunk, limit)


def _key(h: np.ndarray, l: np.ndarray) -> np.ndarray:
    """Keys of phrase hashes in a language; their low bits are free."""
    return scrambled(h ^ l) >> np.uint64(_LOW) << np.uint64(_LOW)


def _place(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - BITS)).astype(np.int64)


def _is_set(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = _place(key)
    return (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _local(key: np.ndarray, g: np.ndarray) -> np.ndarray:
    return scrambled(key ^ g)


def _bitmap(rows: DataFrame, local: bool) -> np.ndarray:
    """Bits of frequent phrases, given as keys (g, key) or as words (g, l, word): 2^BITS of them,
    gathered as at most 2^(BITS - 6) small rows."""
    by_word = "word" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITS - 6), np.uint64)
        for batch in batches:
            if by_word:
                word = block_of(batch.column("word"))
                key = _key(word_hashes(word.data, word.off[:-1], word.off[1:]), batch.column("l").to_numpy().view(np.uint64))
            else:
                key = batch.column("key").to_numpy().view(np.uint64)
            at = _place(_local(key, batch.column("g").to_numpy().view(np.uint64)) if local else key)
            np.bitwise_or.at(bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        slot = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(bits[slot].view(np.int64))], names=["slot", "bits"])

    found = rows.mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _group(lang: Column, shard: Column) -> Column:
    return F.xxhash64(lang, shard.cast("int"))


def _documents(df: DataFrame, id_col: str, text_col: str, lang_col: str, shards: int) -> DataFrame:
    """lang, text, l (hash of the language) and g (hash of language and shard); content alone decides them."""
    shard = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col, F.lit(17)), F.lit(shards))
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return df.select(lang.alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     F.xxhash64(lang).alias("l"), _group(lang, shard).alias("g"))


def _numbered(doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds of a value per document, the first document of each, and the kind of each ``doc``."""
    kinds, one, turn = np.unique(group, return_index=True, return_inverse=True)
    return kinds, one, turn.ravel()[doc]


def word_counts(docs: DataFrame) -> DataFrame:
    """(g, word, n): exact counts of each word in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in texts_of(batches):
            if not len(text.hash):
                continue
            code, vocabulary = text.words.coded
            kinds, _, turn = _numbered(text.doc, batch.column("g").to_numpy())
            pair, n = np.unique((turn * len(vocabulary) + code)[text.own], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds[pair // len(vocabulary)]), vocabulary.take(pa.array(pair % len(vocabulary))).cast(pa.string()), pa.array(n)],
                names=["g", "word", "n"])

    return docs.select("g", "text").mapInArrow(run, "g long, word string, n long").groupBy("g", "word").agg(F.sum("n").alias("n"))


def _counted(docs: DataFrame, k: int, bitmap: np.ndarray) -> DataFrame:
    """(g, key, n): occurrences of phrases of k words whose shorter ends may be frequent in the shard."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    low_bits = np.uint64((1 << _LOW) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = shared.value
        for batch, text in texts_of(batches):
            l, g = (batch.column(c).to_numpy().view(np.uint64) for c in "lg")
            good = np.zeros(len(text.hash), bool)
            for size, at, h in text.phrases(k):
                if size >= k - 1:
                    key = _key(h, l[text.doc[at]])
                if size == k - 1:
                    good[at] = _is_set(may, _local(key, g[text.doc[at]]))
            keep = text.own[at] & good[at] & good[at + 1]
            key = key[keep]
            kinds, _, turn = _numbered(text.doc[at[keep]], g)
            for low in range(0, len(kinds), 1 << _LOW):  # in one go unless a block has many languages
                mine = slice(None) if len(kinds) <= 1 << _LOW else turn >> _LOW == low >> _LOW
                found, n = np.unique(key[mine] | (turn[mine].astype(np.uint64) & low_bits), return_counts=True)
                of = kinds[low + (found & low_bits).astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of.view(np.int64)), pa.array((found & ~low_bits).view(np.int64)), pa.array(n)], names=["g", "key", "n"])

    # Tasks have added up what repeats in their texts; the rest is mostly different and is
    # shuffled as it is, without a second table of partial sums.
    counted = docs.select("text", "l", "g").mapInArrow(run, "g long, key long, n long").repartition("g", "key")
    return counted.groupBy("g", "key").agg(F.sum("n").alias("n"))


def local_phrases(docs: DataFrame, words_: DataFrame, support: int, longest: int) -> np.ndarray:
    """Bitmap of all phrases of two words or more that reach their lowered support in some shard.

    ``words_``: g, l, lang, word, n.
    """
    spark = docs.sparkSession
    in_shard = words_.groupBy("g", "lang").agg(F.sum("n").alias("n_shard"))
    total = in_shard.groupBy("lang").agg(F.sum("n_shard").alias("n_all"))
    need = F.ceil((F.lit(support).cast("decimal(20,0)") * F.col("n_shard")) / F.col("n_all").cast("decimal(20,0)"))
    lowered = handover(in_shard.join(total, "lang").select(F.col("g").alias("of"), need.cast("long").alias("need")), "phrase-support")
    frequent = lambda df: df.join(lowered, (F.col("g") == F.col("of")) & (F.col("n") >= F.col("need")))
    may = _bitmap(frequent(words_).select("g", "l", "word"), local=True)
    union = np.zeros(1 << (BITS - 6), np.uint64)
    for k in range(2, longest + 1):
        keys = handover(frequent(_counted(docs, k, may)).select("g", "key"), "phrase-keys")
        union |= _bitmap(keys, local=False)
        may = _bitmap(keys, local=True) if k < longest else may
        release(spark, keys)
    release(spark, lowered)
    return union


def phrase_counts(docs: DataFrame, candidates: np.ndarray, longest: int) -> DataFrame:
    """(l, phrase, n): exact counts of all candidates of two words or more, by text."""
    shared = docs.sparkSession.sparkContext.broadcast(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = shared.value
        for batch, text in texts_of(batches):
            if not len(text.hash):
                continue
            l = batch.column("l").to_numpy().view(np.uint64)
            code, vocabulary = text.words.coded
            size = len(vocabulary)
            for k, at, h in text.phrases(longest):
                if k == 1:
                    continue
                at = at[text.own[at] & _is_set(may, _key(h, l[text.doc[at]]))]
                kinds, _, number = _numbered(text.doc[at], l)
                lang, most = number, len(kinds)
                for j in range(k):  # equal numbers: equal language and equal words
                    if most * size >= 1 << 62:
                        number = np.unique(number, return_inverse=True)[1].ravel()
                        most = len(number)
                    number, most = number * size + code[at + j], most * size
                _, one, n = np.unique(number, return_index=True, return_counts=True)
                at = at[one]
                parts = [vocabulary.take(pa.array(code[at + j])) for j in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds[lang[one]].view(np.int64)), pc.binary_join_element_wise(*parts, b" ").cast(pa.string()), pa.array(n)],
                    names=["l", "phrase", "n"])

    counted = docs.select("text", "l").mapInArrow(run, "l long, phrase string, n long").repartition("l", "phrase")
    return counted.groupBy("l", "phrase").agg(F.sum("n").alias("n"))


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def weakest_cuts(counts: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per phrase (lang, phrase, words, a) the counts l and r and the score of its lowest-scoring cut."""
    size = F.size("w")
    cuts = phrases.withColumn("w", F.split("phrase", " ", -1)).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    sides = cuts.select("lang", "phrase", "words", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
                        _part(F.col("k") + 1, size - F.col("k")).alias("right"))
    known = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias("_n"))

    def with_count(df: DataFrame, side: str, name: str) -> DataFrame:
        return df.join(known, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_phrase"))).withColumn(name, F.col("_n")).drop("_lang", "_phrase", "_n", side)

    both = with_count(with_count(sides, "left", "l"), "right", "r")
    score = F.expr(f"(cast({SCORE_UNIT} as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    return both.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def inner_phrases(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of the phrases inside a longer one that has ``percent`` of their occurrences or more."""
    size = F.size("w")
    longer = phrases.where("words > 2").withColumn("w", F.split("phrase", " ", -1))
    sub = longer.withColumn("m", F.explode(F.sequence(F.lit(2), size - 1))).withColumn(
        "i", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1))).select("lang", _part(F.col("i"), F.col("m")).alias("phrase"), "a")
    most = sub.groupBy("lang", "phrase").agg(F.max("a").alias("outer_a"))
    return phrases.join(most, ["lang", "phrase"]).where(_wide("outer_a") * 100 >= _wide("a") * percent).select("lang", "phrase")


def collocations(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = MAX_WORDS, top: int = TOP, shards: int = SHARDS, percent: int = INSIDE_PERCENT) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    docs = _documents(df, id_col, text_col, lang_col, shards)
    groups = docs.select("lang", "l").distinct()
    in_shard = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("lang", "l", _group(F.col("lang"), F.col("shard")).alias("g"))
    counted = handover(word_counts(docs), "phrase-words").join(in_shard, "g")
    single = counted.groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("n").alias("n"))
    longer = phrase_counts(docs, local_phrases(docs, counted, support, longest), longest).join(groups, "l").select("lang", "phrase", "n")
    size = F.size(F.split("phrase", " ", -1))
    every = handover(single.unionByName(longer).where(F.col("n") >= support).withColumn("words", size), "phrase-counts")
    phrases = every.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    scored = weakest_cuts(every, phrases).join(inner_phrases(phrases, percent), ["lang", "phrase"], "left_anti")
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked(scored, top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank, from one range sort.

    A row's rank is its place in its sorted partition plus the language's rows in the partitions
    before; only one row per language and partition is gathered for that.
    """
    best = ["lang", F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = handover(scored, "phrase-scores").repartitionByRange(*best).sortWithinPartitions(*best)
    rows = handover(rows.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)), "phrase-order")
    runs = rows.groupBy("lang", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("part")) - F.col("size")
    placed = rows.join(runs.withColumn("before", before), ["lang", "part"])
    return placed.withColumn("rank", F.col("place") - F.col("first") + F.col("before") + 1).where(F.col("rank") <= top)
