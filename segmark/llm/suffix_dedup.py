"""Exact-substring dedup: suffix arrays over the places where a long repeat is possible.

A byte goes if a ``LENGTH``-byte string that covers it also starts elsewhere in the corpus.

1. Anchors. The smallest rolling hash of the ``GRAM``-byte strings inside a window of LENGTH
   bytes depends on the window alone, so two equal windows hold equal anchors at equal
   offsets. Only anchors are shuffled (about one per 70 bytes), each with a hash of its
   context: all bytes of the windows around it.
2. An anchor whose whole context recurs covers its context. An anchor that recurs in other
   contexts only may do so partly; if it also agrees with another on the 68 bytes before or
   after, one of which any shared window must contain, its context bytes go to a shard.
3. Per shard, a suffix array of the contexts by Larsson-Sadakane refinement (order by three
   bytes, then double the depth of the groups that are still tied) and common prefixes by
   Kasai's argument in its Phi form: a prefix is measured only where it cannot follow from
   the position before. Suffixes are compared at equal offsets from equal anchors, so that
   overlapping contexts of one text are not taken for repeats.
4. An anchor with more than ``SHARD_CONTEXTS`` contexts is salted over several shards. Each emits
   its sorted window digests, cut into ranges; per range the sorted runs of all shards are
   merged by binary search, which finds the windows that repeat across shards.

Texts are dealt once to a bucketed table, by a row number, and are read from it twice; what is
joined to them is shuffled to its buckets. Nothing is collected to the driver but counts.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing by themselves.
Repeated rows are copies of each other and lose every byte from LENGTH on. Null ids keep their
rows. Empty tables give empty results. Other input columns are not read.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import handover
from segmark.llm.textblocks import block_of, blocks, scrambled
from segmark.session import scratch_path

LENGTH = 200
GRAM = 64
SPAN = LENGTH - GRAM  # an anchor's context reaches this far before it and LENGTH after its start
HALF = SPAN // 2
SHARD_CONTEXTS = 1500
FIRST = 3  # bytes by which suffixes are ordered before the depth doubles
BLOCK = 1 << 20

_B = 0x9E3779B97F4A7C15
_B_INVERSE = pow(_B, -1, 1 << 64)
_BYTE = scrambled(np.arange(1, 257))


class RollingHash:
    """64-bit hashes of any substring of one byte array."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        up = np.full(n + 1, _B, np.uint64)
        down = np.full(n + 1, _B_INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * np.cumprod(up)[:n], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scrambled((self.total[end] - self.total[start]) * self.down[start])


def _sliding(x: np.ndarray, width: int, op: np.ufunc, filler: int) -> np.ndarray:
    """op over x[i:i + width] for every i; beyond the end x counts as ``filler``."""
    n = len(x)
    blocks_ = -(-(n + width) // width)
    grid = np.full(blocks_ * width, filler, x.dtype)
    grid[:n] = x
    grid = grid.reshape(blocks_, width)
    ahead = op.accumulate(grid, axis=1).ravel()
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of the documents ``data[off[i]:off[i + 1]]``: doc, pos and the hashes of gram (h),
    context (c), and gram with HALF bytes before (l) and after (r); 0 where those do not fit."""
    n = len(data)
    top = np.iinfo(np.uint64).max
    size = np.diff(off)
    end_of = np.repeat(off[1:], size)
    at = np.arange(n)
    rolling = RollingHash(data)
    gram = np.full(n, top, np.uint64)
    inside = np.flatnonzero(at + GRAM <= end_of)
    gram[inside] = rolling.of(inside, inside + GRAM)
    least = _sliding(gram, SPAN + 1, np.minimum, top)
    least[at + LENGTH > end_of] = 0  # no window begins here
    # A gram is an anchor if it is the least of some window it lies in: windows from pos - SPAN to pos.
    reach = _sliding(least[::-1], SPAN + 1, np.maximum, 0)[::-1]
    first = np.repeat(off[:-1], size)
    pos = np.flatnonzero((reach == gram) & (gram < top) & (reach > 0))
    begin, end = np.maximum(pos - SPAN, first[pos]), np.minimum(pos + LENGTH, end_of[pos])
    left, right = pos - HALF >= first[pos], pos + GRAM + HALF <= end_of[pos]
    before = np.where(left, pos - HALF, pos)
    after = np.where(right, pos + GRAM + HALF, pos + GRAM)
    return {
        "doc": np.searchsorted(off, pos, "right") - 1,
        "pos": pos - first[pos],
        "size": end_of[pos] - first[pos],
        "h": gram[pos],
        "c": scrambled(rolling.of(begin, end) ^ scrambled(pos - begin)),
        "l": np.where(left, scrambled(rolling.of(before, pos + GRAM)), np.uint64(0)),
        "r": np.where(right, scrambled(rolling.of(pos, after) + np.uint64(1)), np.uint64(0)),
    }


def _turns(a: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors ordered so that equal contexts of one document are neighbours, and where a kind begins."""
    order = np.lexsort((a["pos"], a["c"], a["h"], a["doc"]))
    d, h, c = (a[x][order] for x in ("doc", "h", "c"))
    return order, np.concatenate(([True], (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (c[1:] != c[:-1]))) if len(d) else np.zeros(0, bool)


def _once(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One anchor of each kind per document, with the number of times it occurs there.

    A looping text has thousands of equal contexts; all but one stay behind, and the
    removal step finds them again (``inner_repeats``).
    """
    order, fresh = _turns(a)
    times = np.diff(np.append(np.flatnonzero(fresh), len(order)))
    return {k: v[order[fresh]] for k, v in a.items()} | {"times": times}


def inner_repeats(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of one document's contexts that recur inside it."""
    a = anchors(data, np.array([0, len(data)]))
    order, fresh = _turns(a)
    kind = np.cumsum(fresh) - 1
    pos = a["pos"][order[np.bincount(kind, minlength=1)[kind] > 1]] if len(order) else np.zeros(0, np.int64)
    return np.maximum(pos - SPAN, 0), np.minimum(pos + LENGTH, len(data))


def _sorted(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``key`` (0 to ``most``), and where in it a new value begins."""
    bits = max(1, (len(key) - 1).bit_length()) if len(key) else 1
    if most.bit_length() + bits <= 63:  # key and index in one integer: a plain sort, several times faster
        packed = np.sort((key << bits) | np.arange(len(key)))
        order, ordered = packed & ((1 << bits) - 1), packed >> bits
    else:
        order = np.argsort(key)
        ordered = key[order]
    return order, np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(key) else np.zeros(0, bool)


def suffix_array(text: np.ndarray, end: np.ndarray, unit: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse over units of ``text``, ordered by level and then by text.

    Position i belongs to ``unit[i]``, which ends at ``end[i]`` with a terminator of its own
    that sorts before all bytes; ``level[i]`` grows by one with i inside a unit.
    """
    n = len(text)
    at = np.arange(n)
    symbol = np.concatenate((text.astype(np.int64) + 1, np.zeros(FIRST, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(FIRST):
        key = key * 257 + np.where(at + j < end, symbol[at + j], 0)
    order, fresh = _sorted(level, int(level.max(initial=0)))
    dense = np.empty(n, np.int64)
    dense[order] = np.cumsum(fresh) - 1
    order, fresh = _sorted(dense * 257**FIRST + key, (n + 1) * 257**FIRST)
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    units = int(unit.max()) + 1 if n else 0
    depth = FIRST
    tied = order[~(fresh & np.concatenate((fresh[1:], [True])))]
    while len(tied):
        onward = tied + depth
        second = np.where(onward < end[tied], rank[np.minimum(onward, n - 1)] + units, unit[tied])
        old = rank[tied]
        order, fresh = _sorted(old * np.int64(n + units + 1) + second, n * (n + units + 1))
        tied, old = tied[order], old[order]
        group = np.concatenate(([True], old[1:] != old[:-1]))
        index = np.arange(len(tied))
        rank[tied] = old + (index[fresh] - index[group][np.cumsum(group) - 1][fresh])[np.cumsum(fresh) - 1]
        tied = tied[~(fresh & np.concatenate((fresh[1:], [True])))]
        depth *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = at
    return sa, rank


def common_prefixes(text: np.ndarray, end: np.ndarray, level: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position the suffix before it in the array (-1: none on its level) and their common prefix."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    same = level[sa[1:]] == level[sa[:-1]]
    before[sa[1:][same]] = sa[:-1][same]
    has = before >= 0
    at = np.arange(n)
    unit_start = np.concatenate(([True], end[1:] != end[:-1])) if n else np.zeros(0, bool)
    follows = has & ~unit_start
    follows[follows] = ~unit_start[before[follows]]
    follows[follows] = text[at[follows] - 1] == text[before[follows] - 1]
    value = np.zeros(n, np.int64)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    word = np.zeros(n, np.uint64)
    for j in range(8):
        word |= padded[j:j + n].astype(np.uint64) << np.uint64(8 * j)
    i = np.flatnonzero(has & ~follows)
    j = before[i]
    most = np.minimum(end[i] - i, end[j] - j)
    have = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        live = live[have[live] < most[live]]
        differ = word[i[live] + have[live]] ^ word[j[live] + have[live]]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        have[live] += equal
        live = live[equal == 8]
    value[i] = np.minimum(have, most)
    first = np.where(follows, -1, value + at)
    return before, np.maximum(np.maximum.accumulate(first) - at, 0) if n else value


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shard_repeats(contexts: list[bytes], h: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the contexts that recur at the same offset from the same anchor in another one.

    Returns, per position of the joined contexts: repeats, whether a window fits there, its
    unit, and its index among equal windows (0 for the first of each kind).
    """
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    off = np.concatenate(([0], np.cumsum(size)))
    text = np.frombuffer(b"".join(contexts), np.uint8)
    unit = np.repeat(np.arange(len(contexts)), size)
    end = off[1:][unit]
    kind = np.unique(h, return_inverse=True)[1]
    level = kind[unit] * (4 * LENGTH) + (np.arange(len(text)) - off[:-1][unit]) - left[unit] + LENGTH
    sa, _ = suffix_array(text, end, unit, level)
    before, prefix = common_prefixes(text, end, level, sa)
    fits = np.arange(len(text)) + LENGTH <= end
    linked = np.flatnonzero(fits & (before >= 0) & (prefix >= LENGTH))
    repeats = np.zeros(len(text), bool)
    repeats[linked] = True
    repeats[before[linked]] = True
    later = np.zeros(len(text), bool)
    later[linked] = True
    return repeats, fits, unit, later


def _covered(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows that begin at the marked positions of a context."""
    mark = np.zeros(size + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + LENGTH, -1)
    return _runs(np.cumsum(mark[:-1]) > 0)


_SPANS = "row long, start long, end long, h long, part int, digest binary, place binary"


def _span_table(row, start, end, h=None, part=None, digest=None, place=None) -> pa.Table:
    n = len(row) if len(row) else len(h or [])
    null = lambda x, t: pa.array(x, t) if x is not None and len(x) else pa.nulls(n, t)
    return pa.table({"row": null(row, pa.int64()), "start": null(start, pa.int64()), "end": null(end, pa.int64()), "h": null(h, pa.int64()),
                     "part": null(part, pa.int32()), "digest": null(digest, pa.binary()), "place": null(place, pa.binary())})


def _search_shard(key: tuple, table: pa.Table) -> pa.Table:
    """Covered spans of a shard's single contexts; for a salted anchor also its sorted window digests."""
    contexts = table.column("context").to_pylist()
    col = {c: table.column(c).to_numpy() for c in ("h", "left", "row", "start", "single", "parts")}
    repeats, fits, unit, later = shard_repeats(contexts, col["h"], col["left"])
    off = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    rows: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    marked = np.flatnonzero(repeats & col["single"][unit])
    for u in np.unique(unit[marked]):
        own = marked[(np.searchsorted(marked, off[u])):np.searchsorted(marked, off[u + 1])] - off[u]
        a, b = _covered(own, len(contexts[u]))
        rows += [int(col["row"][u])] * len(a)
        starts += (a + col["start"][u]).tolist()
        ends += (b + col["start"][u]).tolist()
    found = _span_table(rows, starts, ends)
    parts = int(col["parts"].max())
    if parts <= 1:
        return found
    # One sorted run per range: a digest for each kind of window, and for a kind with one window its place.
    one = np.flatnonzero(fits & ~later)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    level = (one - off[:-1][unit[one]]) - col["left"][unit[one]]
    digest = scrambled(RollingHash(text).of(one, one + LENGTH) ^ scrambled(level + LENGTH))
    open_ = ~repeats[one] & col["single"][unit[one]]
    place = np.stack((np.where(open_, col["row"][unit[one]], -1), col["start"][unit[one]] + one - off[:-1][unit[one]]), axis=1)
    order = np.argsort(digest)
    digest, place = digest[order], np.ascontiguousarray(place[order])
    cut = np.searchsorted(digest, np.array([(i << 64) // parts for i in range(parts)], np.uint64)).tolist() + [len(digest)]
    runs = [(p, digest[i:j].tobytes(), place[i:j].tobytes()) for p, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if j > i]
    more = _span_table([], None, None, [int(col["h"][0])] * len(runs), *[list(x) for x in zip(*runs, strict=True)])
    return pa.concat_tables([found, more])


def _merge_runs(table: pa.Table) -> pa.Table:
    """Windows whose digest is in the run of another shard, by binary search in the merged runs."""
    digests = [np.frombuffer(x, np.uint64) for x in table.column("digest").to_pylist()]
    places = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in table.column("place").to_pylist()]
    merged = np.sort(np.concatenate(digests))
    out = []
    for d, p in zip(digests, places, strict=True):
        elsewhere = np.searchsorted(merged, d, "right") - np.searchsorted(merged, d, "left") > 1
        out.append(p[elsewhere & (p[:, 0] >= 0)])
    hit = np.concatenate(out)
    hit = hit[np.lexsort((hit[:, 1], hit[:, 0]))]
    if not len(hit):
        return pa.table({"row": pa.array([], pa.int64()), "start": pa.array([], pa.int64()), "end": pa.array([], pa.int64())})
    # Neighbouring windows of a text join into one span before they leave the task.
    head = np.concatenate(([True], (hit[1:, 0] != hit[:-1, 0]) | (hit[1:, 1] > hit[:-1, 1] + LENGTH)))
    tail = np.concatenate((head[1:], [True]))
    return pa.table({"row": pa.array(hit[head, 0]), "start": pa.array(hit[head, 1]), "end": pa.array(hit[tail, 1] + LENGTH)})


def _dealt(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id and text in a bucketed table, written once to the shared folder."""
    spark = df.sparkSession
    buckets = min(100_000, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"llm_texts_{uuid.uuid4().hex}"
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows.repartition(buckets, "row").write.bucketBy(buckets, "row").option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def _occurrences(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "text", BLOCK):
            a = _once(anchors(block.data, block.off))
            row = batch.column("row").to_numpy(zero_copy_only=False)[a["doc"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), *[pa.array(a[x], pa.int64()) for x in ("pos", "size", "times")],
                 *[pa.array(a[x].view(np.int64)) for x in "hclr"]], names=["row", "pos", "size", "times", *"hclr"])

    return texts.select("row", "text").mapInArrow(run, "row long, pos long, size long, times long, h long, c long, l long, r long")


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per context) with its bytes, cut from the texts in their buckets."""
    fields = ("start", "stop", "h", "left", "single", "k1", "k2", "parts")
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("asked"))
    both = texts.select("row", "text").join(per_row.hint("shuffle_merge"), "row")
    schema = "row long, start long, h long, left long, single boolean, k1 long, k2 long, parts int, context binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = block_of(batch.column("text"))
            asked = batch.column("asked")
            n = np.diff(asked.offsets.to_numpy())
            doc = np.repeat(np.arange(len(block)), n)
            x = asked.flatten()
            get = lambda c: x.field(c).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            base = block.off[doc]
            data = block.data.tobytes()
            cut = [data[i:j] for i, j in zip((base + get("start")).tolist(), (base + get("stop")).tolist(), strict=True)]
            row = batch.column("row").to_numpy(zero_copy_only=False)[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), *[x.field(c) for c in ("start", "h", "left", "single", "k1", "k2", "parts")], pa.array(cut, pa.binary())],
                names=["row", "start", "h", "left", "single", "k1", "k2", "parts", "context"])

    return both.mapInArrow(run, schema)


def repeated_spans(texts: DataFrame, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(row, start, end, inner): spans that cover every repeated byte; they may overlap. ``inner``: the
    text repeats a context in itself, of which only one is listed (``inner_repeats`` has all)."""
    by_gram = Window.partitionBy("h")
    by_context = Window.partitionBy("h", "c").orderBy("row", "pos")
    all_of = by_context.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = _occurrences(texts).withColumns({
        "turn": F.row_number().over(by_context), "same": F.sum("times").over(all_of)}).withColumn(
        "any", F.sum("times").over(by_gram)).where(F.col("any") > 1)
    start, stop = F.greatest(F.lit(0), F.col("pos") - SPAN), F.least(F.col("size"), F.col("pos") + LENGTH)
    again = handover(counted.select("row", start.alias("start"), stop.alias("stop"), (F.col("pos") - start).alias("left"),
                                    "h", "c", "l", "r", "turn", "same", "any", (F.col("times") > 1).alias("inner")), "repeat-anchors")
    whole = again.where(F.col("same") > 1).select("row", "start", F.col("stop").alias("end"), "inner")
    # One context of each kind, where the anchor has several kinds that agree on one side.
    kinds = again.where((F.col("turn") == 1) & (F.col("any") > F.col("same")))
    side = lambda c: (F.col(c) != 0) & (F.count(F.lit(1)).over(Window.partitionBy("h", c)) > 1)
    both = kinds.withColumns({"on_l": side("l"), "on_r": side("r")}).where("on_l or on_r")
    # Without a match on one side only windows that lie mostly on the other can recur.
    first = F.when(F.col("on_l"), F.col("start")).otherwise(F.greatest("start", F.col("start") + F.col("left") - (HALF - 1)))
    last = F.when(F.col("on_r"), F.col("stop")).otherwise(F.least("stop", F.col("start") + F.col("left") + (LENGTH - HALF)))
    partial = both.select("row", first.alias("start"), last.alias("stop"), (F.col("start") + F.col("left") - first).alias("left"),
                          "h", "c", (F.col("same") == 1).alias("single")).where(F.col("stop") - F.col("start") >= LENGTH)
    partial = handover(partial, "partial-contexts")
    total = partial.count()
    parts = F.ceil(F.count(F.lit(1)).over(by_gram) / F.lit(shard_contexts)).cast("int")
    shards = max(1, -(-total // shard_contexts))
    wanted = partial.withColumn("parts", parts).withColumns({
        "k1": F.when(F.col("parts") == 1, F.pmod(F.xxhash64("h"), F.lit(shards))).otherwise(F.col("h")),
        "k2": F.when(F.col("parts") == 1, F.lit(-1)).otherwise(F.pmod("c", "parts")).cast("long")})
    searched = handover(_contexts(texts, wanted).groupBy("k1", "k2").applyInArrow(_search_shard, _SPANS), "shard-spans")
    inside = searched.where(F.col("row").isNotNull()).select("row", "start", "end")
    across = searched.where(F.col("digest").isNotNull()).select("h", "part", "digest", "place").groupBy("h", "part").applyInArrow(
        _merge_runs, "row long, start long, end long")
    return whole.unionByName(inside.unionByName(across).withColumn("inner", F.lit(False)))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """Per row: id, n_bytes, spans (maximal removed runs, byte offsets) and kept (the remaining bytes)."""
    texts = _dealt(df, id_col, text_col)
    spans = repeated_spans(texts, shard_contexts).groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans"), F.max("inner").alias("_inner"))
    both = texts.join(spans.hint("shuffle_merge"), "row", "left").select("id", "text", "_spans", "_inner")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField(id_col, both.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", span), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "text", BLOCK):
            column = batch.column("_spans")
            n = np.diff(column.offsets.to_numpy()) * column.is_valid().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(block)), n)
            x = column.flatten()
            begin, end = (block.off[doc] + x.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end"))
            mark = np.zeros(len(block.data) + 1, np.int32)
            np.add.at(mark, begin, 1)
            np.add.at(mark, end, -1)
            for d in np.flatnonzero(np.array(batch.column("_inner").fill_null(False))):
                a, b = inner_repeats(block.data[block.off[d]:block.off[d + 1]])
                np.add.at(mark, a + block.off[d], 1)
                np.add.at(mark, b + block.off[d], -1)
            gone = np.cumsum(mark[:-1]) > 0
            left = np.concatenate(([0], np.cumsum(~gone)))[block.off]
            head = gone.copy()
            if len(gone):
                head[1:] &= ~gone[:-1]
                first = block.off[:-1][block.off[:-1] < len(gone)]
                head[first] = gone[first]
            a = np.flatnonzero(head)
            cuts = np.concatenate((a, [len(gone)]))
            removed = np.concatenate(([0], np.cumsum(gone)))
            owner = block.doc_of(a)
            b = a + removed[np.minimum(cuts[1:], block.off[owner + 1])] - removed[a]
            spans_off = np.searchsorted(owner, np.arange(len(block) + 1))
            out = pa.StructArray.from_arrays([pa.array(a - block.off[owner]), pa.array(b - block.off[owner])], names=["start", "end"])
            kept = pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(left.astype(np.int32)),
                                                                   pa.py_buffer(np.ascontiguousarray(block.data[~gone]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(block.off), pa.int64()), pa.ListArray.from_arrays(pa.array(spans_off, pa.int32()), out), kept],
                names=[id_col, "n_bytes", "spans", "kept"])

    return both.mapInArrow(run, schema)
