"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint is the bitwise majority of the XXH64 values of a text's 4-word shingles. Two
fingerprints within distance 4 share a 64-bit value within distance 2 of both, so every
distinct fingerprint emits all 2,081 variants of its radius-2 ball and fingerprints meet on
variants. Those that share a variant are linked with certainty (2 + 2), so a chain to the
smallest one keeps the components whole without emitting pairs; each emitted pair is verified.

Variants travel folded: those of one fingerprint that agree on the low ``ROUTE_BITS`` bits are
one shuffled row, (route, fingerprint), and unfold in the task that owns the route. With 16
route bits that is 137 rows instead of 2,081. Rows arrive sorted by route; a task unfolds
whole routes, a bounded number of variants at a time.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any
other; a text of fewer than four words is one shingle. Exact copies collapse before the
ball. component_id is the smallest id reachable; it is null if all reachable ids are null.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import free_name, handover, release, without
from segmark.llm.components import connected_components
from segmark.llm.textblocks import NOT_SPACE, Block, blocks, recurring, words

SHINGLE = 4
SEED = 42
RADIUS = 2
ROUTE_BITS = 16
MAX_VARIANTS = 2_000_000
LANE = (1 << 16) - 1  # the largest count in a lane of 16 bits
LANES = np.uint64(0x0001000100010001)  # a one in each of four lanes


def fingerprints(block: Block) -> np.ndarray:
    """Unsigned 64-bit SimHash of each document of a block."""
    w = words(block.lowered(), NOT_SPACE)
    out = np.zeros(len(block), np.uint64)
    if not len(w):
        return out
    # Words joined by one space: word j moves to the right by the separators before it.
    length = w.end - w.start
    begin = np.concatenate(([0], np.cumsum(length + 1)[:-1]))
    joined = np.full(int(length.sum()) + len(w), 0x20, np.uint8)
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(len(w)), length)] = w.block.data[w.inside]
    n_words = np.diff(w.first)
    n = np.where(n_words > 0, np.maximum(n_words - SHINGLE + 1, 1), 0)
    docs = np.flatnonzero(n)
    n = n[docs]
    base = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(w.first[:-1][docs] - base[:-1], n) + np.arange(base[-1])
    last = np.minimum(at + SHINGLE - 1, np.repeat(w.first[1:][docs], n) - 1)
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    h = np.fromiter((digest(view[i:j], SEED) for i, j in zip(begin[at].tolist(), (begin[last] + length[last]).tolist(), strict=True)),
                    np.uint64, int(base[-1]))
    step = LANE  # so many can be counted in a lane
    ones = np.zeros((len(docs), 64), np.int64)
    for i in range(0, len(h), step):
        part = h[i:i + step]
        lo = int(np.searchsorted(base, i, "right")) - 1
        hi = int(np.searchsorted(base, min(i + step, len(h)), "left"))
        cuts = np.maximum(base[lo:hi] - i, 0)
        for bit in range(16):  # and the three that lie 16, 32 and 48 above it
            lanes = np.add.reduceat((part >> np.uint64(bit)) & LANES, cuts)
            for up in range(0, 64, 16):
                ones[lo:hi, 63 - bit - up] += ((lanes >> np.uint64(up)) & np.uint64(LANE)).astype(np.int64)
    majority = np.packbits(2 * ones > n[:, None], axis=1)
    out[docs] = majority.view(">u8").reshape(-1).astype(np.uint64)
    return out


def with_fingerprint(df: DataFrame, text_col: str = "text", name: str = "fp", keep_text: bool = False) -> DataFrame:
    """``df`` with the signed 64-bit SimHash of its text; the text itself is dropped unless kept."""
    rows = without(df, {name} - {text_col.lower()})
    kept = [c for c in rows.columns if keep_text or c != text_col]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, text_col):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(fingerprints(block).view(np.int64))], names=[*kept, name])

    return rows.mapInArrow(run, schema)


def _route_masks() -> list[int]:
    return [sum(1 << b for b in bits) for k in range(RADIUS + 1) for bits in combinations(range(ROUTE_BITS), k)]


def _free_masks(k: int) -> np.ndarray:
    """Flips of at most ``k`` bits outside the route."""
    return np.array([sum(1 << b for b in bits) for j in range(k + 1) for bits in combinations(range(ROUTE_BITS, 64), j)], np.uint64)


def _unfold(route: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (variant, fingerprint) pairs of folded rows."""
    low = np.uint64((1 << ROUTE_BITS) - 1)
    flips = np.bitwise_count((fp & low) ^ route)
    variants, owners = [], []
    for used in range(RADIUS + 1):
        at = flips == used
        masks = _free_masks(RADIUS - used)
        base = (fp[at] & ~low) | route[at]
        variants.append((base[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(fp[at], len(masks)))
    return np.concatenate(variants), np.concatenate(owners)


def _links(route: np.ndarray, fp: np.ndarray, parts: int = 1) -> np.ndarray:
    """Verified (smallest, other) links of whole routes, in ``parts`` passes over the variants."""
    out = [np.zeros((0, 2), np.uint64)]
    step = -(-len(route) // parts)
    for part in range(parts):
        vs, os_ = [], []
        for i in range(0, len(route), step):
            v, o = _unfold(route[i:i + step], fp[i:i + step])
            if parts > 1:
                own = (v >> np.uint64(ROUTE_BITS)) % np.uint64(parts) == part
                v, o = v[own], o[own]
            vs.append(v)
            os_.append(o)
        v, o = np.concatenate(vs), np.concatenate(os_)
        met = recurring(v)
        v, o = v[met], o[met]
        order = np.lexsort((o, v))
        v, o = v[order], o[order]
        head = np.concatenate(([True], v[1:] != v[:-1])) if len(v) else np.zeros(0, bool)
        smallest = o[np.flatnonzero(head)][np.cumsum(head) - 1] if len(v) else o
        pair = np.unique(np.stack((smallest, o), 1)[smallest != o], axis=0)
        out.append(pair[np.bitwise_count(pair[:, 0] ^ pair[:, 1]) <= 2 * RADIUS])
    return np.unique(np.concatenate(out), axis=0)


def _weight(route: np.ndarray, fp: np.ndarray) -> np.ndarray:
    per = np.array([len(_free_masks(RADIUS - k)) for k in range(RADIUS + 1)])
    return per[np.bitwise_count((fp & np.uint64((1 << ROUTE_BITS) - 1)) ^ route)]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unfold runs of whole routes (rows sorted by route) and emit the links found in them."""

    def emit(route: np.ndarray, fp: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _links(route, fp, max(1, -(-int(weight.sum()) // (2 * MAX_VARIANTS)))).view(np.int64)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        route = batch.column("route").to_numpy(zero_copy_only=False).astype(np.uint64)
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        weight = _weight(route, fp)
        held.append((route, fp, weight))
        size += int(weight.sum())
        if size < MAX_VARIANTS:
            continue
        route, fp, weight = (np.concatenate(x) for x in zip(*held, strict=True))
        done = int(np.searchsorted(route, route[-1]))  # the last route may go on in the next batch
        total = np.cumsum(weight[:done])
        cut = 0
        while cut < done:
            upto = int(np.searchsorted(total, (total[cut - 1] if cut else 0) + MAX_VARIANTS, "right"))
            upto = int(np.searchsorted(route, route[min(upto, done - 1)], "right" if upto >= done else "left"))
            if upto <= cut:  # one route alone is larger
                upto = int(np.searchsorted(route, route[cut], "right"))
            upto = min(upto, done)
            yield from emit(route[cut:upto], fp[cut:upto], weight[cut:upto])
            cut = upto
        held, size = [(route[done:], fp[done:], weight[done:])], int(weight[done:].sum())
    if held and size:
        yield from emit(*(np.concatenate(x) for x in zip(*held, strict=True)))


def near_links(fps: DataFrame) -> DataFrame:
    """Links (a, b: long) that connect all distinct ``fp`` within distance 4 of each other."""
    mask = F.explode(F.array(*[F.lit(m).cast("long") for m in _route_masks()]))
    low = F.lit((1 << ROUTE_BITS) - 1).cast("long")
    folded = fps.where(F.col("fp").isNotNull()).select("fp").distinct().select("fp", mask.alias("mask")).select(
        F.col("fp").bitwiseAND(low).bitwiseXOR(F.col("mask")).alias("route"), "fp")
    return folded.repartition("route").sortWithinPartitions("route").mapInArrow(_meet, "a long, b long").distinct()


def _members(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The written fingerprints (id, ``keep``, fp) and, per fp, its component's root and component_id."""
    rows = df.select(*dict.fromkeys([id_col, *keep, text_col]))
    printed = handover(with_fingerprint(rows, text_col, "fp", text_col in keep), "simhash-fp")
    first = printed.groupBy("fp").agg(F.min(id_col).alias("least"))
    linked = connected_components(near_links(printed))
    at = first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "least")
    at = handover(at, "simhash-roots")
    owner = at.groupBy("root").agg(F.min("least").alias("component_id"))
    member = handover(at.join(owner, "root").select("fp", "root", "component_id"), "simhash-member")
    release(df.sparkSession, at)
    return printed, member


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, ``keep`` columns, fingerprint (16 hex digits) and component_id."""
    keep = tuple(c for c in keep if c.lower() not in ("fingerprint", "component_id"))
    printed, member = _members(df, id_col, text_col, keep)
    cols = [F.col(f"`{c}`") for c in dict.fromkeys([id_col, *keep])]
    return printed.join(member.drop("root"), "fp").select(
        *cols, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays: that of its smallest id (null last; of a repeated id, one text).

    Only ids, fingerprints and 64-bit marks of the texts take part in the search. A text has one
    fingerprint, so id and mark lie in one component; the texts are shuffled once, by both,
    against the one (id, mark) of each component that stays.
    """
    mark = free_name(df, "_near_mark")
    marked = df.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    printed, member = _members(marked, id_col, text_col, (mark,))
    first = printed.join(member.select("fp", "root"), "fp").groupBy("root").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(mark).alias("mark"))).alias("first"))
    stay = first.select(F.col("first.id").alias("id"), F.col("first.mark").alias("mark")).alias("stay")
    kept = marked.join(stay, marked[id_col].eqNullSafe(F.col("stay.id")) & (marked[mark] == F.col("stay.mark")), "left_semi")
    return kept.dropDuplicates([id_col, mark]).drop(mark)
