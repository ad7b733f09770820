"""Approximate nearest neighbours over learned partitions of a neighbour graph.

1. Sample. Of the distinct vectors, at most ``MAX_SAMPLE`` rows (and ``SAMPLE_BYTES``), spread by
   a hash of the vector, are the only rows the partitions are learned from. A tenth of them is
   kept apart for calibration.
2. Graph. The sample's nearest neighbours are found in blocks by Spark tasks. The graph is split
   into parts of equal size: recursive median cuts along the main direction, then moves and swaps
   that put nodes beside their neighbours as long as no part grows beyond its share by a tenth.
3. Router. A softmax classifier on the vector and its squared length learns a node's own part and
   those of its neighbours; it starts from the parts' centres.
4. Index. Every row is routed to its most probable part and written, with its part, to the shared
   folder. The number of parts follows the number of distinct vectors.
5. Search. A query goes to its most probable parts; how many is the smallest number that holds
   ``TARGET`` of the true neighbours of the calibration rows. All rows of those parts are ranked by
   exact distance. A part of many rows is salted into blocks of ``BLOCK_ROWS``, many queries of one
   part into blocks of their own.

Copies. A vector with more than k + 1 copies is indexed with its k + 1 smallest ids: the others
can be no query's result. Equal query vectors are searched once and their results joined back.

Defined results: vectors that are null, empty, all zero or hold a null or non-finite component
take no part, nor do rows without an id, nor vectors whose length is not the most frequent one
(the longer on ties). Rows that repeat id and vector count once. A query's own id is left out.
With fewer candidates than k all that were found are returned. Ties go to the smaller id. Empty
tables give empty results. Other input columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmark.llm.common import handover

K = 10
ROWS_PER_PART = 512
MAX_PARTS = 1024
SAMPLE_PER_PART = 48
MAX_SAMPLE = 48 * 1024
SAMPLE_BYTES = 32 << 20
GRAPH_NEIGHBOURS = 10
TARGET = 0.95
BLOCK_ROWS = 8192
SALT = 16
EPOCHS = 30

RESULT = "query_id long, rank int, vec_id long, score double"


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where(
        F.col("vec_id").isNotNull() & _usable(F.col("v")))
    top = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.where(F.size("v") == (top["n"] if top else 0))


def _matrix(vectors: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


# ---- sample and graph -------------------------------------------------------------------
def nearest_in_sample(df_rows: DataFrame, shared, first: int, k: int) -> DataFrame:
    """(i, near): the k nearest of the first ``first`` sample rows for the rows named in ``df_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        base = x[:first]
        norm = (base * base).sum(axis=1)
        for batch in batches:
            every = batch.column("id").to_numpy()
            for at in range(0, len(every), 1024):
                i = every[at:at + 1024]
                d = norm - 2 * x[i] @ base.T
                own = i < first
                d[np.flatnonzero(own), i[own]] = np.inf
                near = np.argpartition(d, k - 1, axis=1)[:, :k]
                off = np.arange(0, k * len(i) + 1, k, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.ListArray.from_arrays(pa.array(off), pa.array(near.ravel().astype(np.int32)))], names=["i", "near"])

    return df_rows.mapInArrow(run, "i long, near array<int>")


def _cut(x: np.ndarray, rows: np.ndarray, first: int, parts: int, out: np.ndarray) -> None:
    """Parts ``first`` to ``first + parts - 1`` for ``rows``, by cuts across the main direction."""
    if parts == 1 or not len(rows):
        out[rows] = first
        return
    y = x[rows] - x[rows].mean(axis=0)
    v = np.random.default_rng(parts).normal(size=y.shape[1])
    for _ in range(8):
        v = y.T @ (y @ v)
        v /= np.linalg.norm(v) + 1e-300
    order = np.argsort(y @ v, kind="stable")
    low = parts // 2
    cut = len(rows) * low // parts
    _cut(x, rows[order[:cut]], first, low, out)
    _cut(x, rows[order[cut:]], first + low, parts - low, out)


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Part of each node: few neighbour links across parts, none above its share by over a tenth.

    Each round every node names the part that most of its neighbours (in both directions) are in.
    Moves are taken by falling gain while the part has room; two nodes that want each other's
    parts swap.
    """
    n = len(x)
    part = np.zeros(n, np.int64)
    _cut(x, np.arange(n), 0, parts, part)
    limit = max(int(np.ceil(1.1 * n / parts)), 1)
    a = np.concatenate((np.repeat(np.arange(n), near.shape[1]), near.ravel()))
    b = np.concatenate((near.ravel(), np.repeat(np.arange(n), near.shape[1])))
    for _ in range(rounds):
        key, links = np.unique(a * parts + part[b], return_counts=True)
        node, towards = key // parts, key % parts
        own = np.zeros(n, np.int64)
        here = towards == part[node]
        own[node[here]] = links[here]
        order = np.lexsort((links, node))
        last = np.concatenate((node[order][1:] != node[order][:-1], [True]))
        best = order[last]
        want = np.full(n, -1, np.int64)
        gain = np.zeros(n, np.int64)
        want[node[best]], gain[node[best]] = towards[best], links[best]
        gain -= own
        movers = np.flatnonzero((gain > 0) & (want != part))
        size = np.bincount(part, minlength=parts)
        waiting: dict[tuple[int, int], list[int]] = {}
        moved = 0
        for i in movers[np.argsort(-gain[movers], kind="stable")].tolist():
            p, w = int(part[i]), int(want[i])
            if size[w] < limit:
                size[p] -= 1
                size[w] += 1
                part[i] = w
                moved += 1
            elif partner := waiting.get((w, p)):
                j = partner.pop()
                part[i], part[j] = w, p
                moved += 2
            else:
                waiting.setdefault((p, w), []).append(i)
        if moved * 200 < n:
            break
    return part


# ---- router -----------------------------------------------------------------------------
def _features(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, (x * x).sum(axis=1, keepdims=True)), axis=1)


@dataclass
class Router:
    """Softmax over parts: features are centred and scaled, then weighed."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((_features(x) - self.mean) / self.scale) @ self.weight + self.bias


def train_router(x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, epochs: int = EPOCHS) -> Router:
    """Softmax regression by Adam; a node's target is half its own part, half its neighbours' parts."""
    f = _features(x)
    mean, scale = f.mean(axis=0), f.std(axis=0) + 1e-9
    f = (f - mean) / scale
    rng = np.random.default_rng(11)
    centre = np.stack([f[part == p].mean(axis=0) if (part == p).any() else f.mean(axis=0) for p in range(parts)])
    spread = max(float(((f - centre[part]) ** 2).sum(axis=1).mean()), 1e-9)
    heat = 2.0 * f.shape[1] / spread
    w, b = (heat * centre.T / f.shape[1] * 2).copy(), -heat * (centre**2).sum(axis=1) / f.shape[1]
    state = [np.zeros_like(w), np.zeros_like(b), np.zeros_like(w), np.zeros_like(b)]
    step = 0
    for _ in range(epochs if parts > 1 else 0):
        order = rng.permutation(len(f))
        for at in range(0, len(f), 512):
            rows = order[at:at + 512]
            target = np.zeros((len(rows), parts))
            np.add.at(target, (np.arange(len(rows)), part[rows]), 0.5)
            np.add.at(target, (np.repeat(np.arange(len(rows)), near.shape[1]), part[near[rows]].ravel()), 0.5 / near.shape[1])
            z = f[rows] @ w + b
            e = np.exp(z - z.max(axis=1, keepdims=True))
            g = (e / e.sum(axis=1, keepdims=True) - target) / len(rows)
            step += 1
            for i, (value, grad) in enumerate(((w, f[rows].T @ g + 1e-4 * w), (b, g.sum(axis=0)))):
                state[i] = 0.9 * state[i] + 0.1 * grad
                state[i + 2] = 0.999 * state[i + 2] + 0.001 * grad * grad
                value -= 0.02 * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 2] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, w, b, 1)


def calibrated_probes(router: Router, base: np.ndarray, asked: np.ndarray, near: np.ndarray, target: float) -> int:
    """Parts to probe so that ``target`` of the true neighbours of ``asked`` (indexes into ``base``) are met."""
    home = router.logits(base).argmax(axis=1)
    z = router.logits(asked)
    place = (z[:, :, None] > np.take_along_axis(z, home[near], axis=1)[:, None, :]).sum(axis=1)
    need = np.sort(place.ravel())
    return int(need[min(len(need) - 1, int(np.ceil(target * len(need))) - 1)]) + 1


# ---- index ------------------------------------------------------------------------------
@dataclass
class Index:
    """The router and the written rows (vec_id, v, part)."""

    router: Router | None
    rows: DataFrame
    parts: int


def _routed(df: DataFrame, router: Router, probes: int) -> DataFrame:
    """``df`` (id, v) with its ``probes`` most probable parts, one row each."""
    shared = df.sparkSession.sparkContext.broadcast(vars(router))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Router(**shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                z = own.logits(_matrix(batch.column("v")))
                take = min(probes, z.shape[1])
                top = np.argpartition(-z, take - 1, axis=1)[:, :take] if take < z.shape[1] else np.tile(np.arange(take), (len(z), 1))
                row = pa.array(np.repeat(np.arange(len(z)), take))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(row) for c in names], pa.array(top.ravel().astype(np.int32))], names=[*names, "part"])

    return df.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields) + ", part int")


def build_index(df: DataFrame, k: int = K, target: float = TARGET, rows_per_part: int = ROWS_PER_PART) -> Index:
    """Learn the parts on the sample of ``df`` (usable vectors: vec_id, v) and route every row."""
    spark = df.sparkSession
    key = [F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2")]
    light = df.select("vec_id", *key).distinct()
    # The k + 1 smallest ids of a vector, in two steps so that no task gets all copies of one.
    salted = Window.partitionBy("h1", "h2", F.pmod(F.xxhash64("vec_id"), F.lit(SALT))).orderBy("vec_id")
    of_one = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = light.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k + 1).drop("n")
    ranked = handover(few.withColumn("n", F.row_number().over(of_one)).where(F.col("n") <= k + 1), "ann-distinct")
    firsts = ranked.where("n = 1")
    distinct = firsts.count()
    if not distinct:
        return Index(None, df, 0)
    kept = df.select("vec_id", "v", *key).join(
        ranked.where(F.col("n") == k + 1).select("h1", "h2", F.col("vec_id").alias("last")), ["h1", "h2"], "left").where(
        F.col("last").isNull() | (F.col("vec_id") <= F.col("last"))).select("vec_id", "v")
    width = len(df.first()["v"])
    parts = max(1, min(MAX_PARTS, -(-distinct // rows_per_part)))
    size = min(parts * SAMPLE_PER_PART, MAX_SAMPLE, SAMPLE_BYTES // (8 * width), distinct)
    parts = max(1, min(parts, size // (2 * GRAPH_NEIGHBOURS)))
    if parts == 1:
        router = Router(np.zeros(width + 1), np.ones(width + 1), np.zeros((width + 1, 1)), np.zeros(1), 1)
    else:
        chosen = firsts.orderBy("h1", "h2").limit(size).select("vec_id", "h1", "h2")  # bounded, spread by hash
        near_ids = df.select("vec_id", "v", *key).join(F.broadcast(chosen), ["vec_id", "h1", "h2"], "left_semi")
        found = near_ids.dropDuplicates(["h1", "h2"]).select("h1", "v").toArrow()
        x = _matrix(found.column("v"))[np.argsort(found.column("h1").to_numpy(), kind="stable")]
        x = x[np.random.default_rng(3).permutation(len(x))]
        first = len(x) - max(1, len(x) // 10)
        shared = spark.sparkContext.broadcast(x)
        graph = nearest_in_sample(spark.range(0, len(x), 1, max(1, len(x) // 1024)), shared, first, GRAPH_NEIGHBOURS).toArrow()
        near = np.zeros((len(x), GRAPH_NEIGHBOURS), np.int64)
        near[graph.column("i").to_numpy()] = _matrix(graph.column("near"), np.int64)
        part = balanced_parts(x[:first], near[:first], parts)
        router = train_router(x[:first], near[:first], part, parts)
        router.probes = calibrated_probes(router, x[:first], x[first:], near[first:], target)
        shared.unpersist()
    return Index(router, handover(_routed(kept, router, 1), "ann-index"), parts)


# ---- search -----------------------------------------------------------------------------
def _ranked_block(k: int):
    """Per query of the block its k + 1 nearest rows of the block, by exact distance and id."""

    def run(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.table({"cls": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not rows.num_rows or not asked.num_rows:
            return none
        x, ids = _matrix(rows.column("v")), rows.column("vec_id").to_numpy()
        q, cls = _matrix(asked.column("v")), asked.column("cls").to_numpy()
        # Equal rows once, copies of a vector by their smallest ids.
        as_bytes = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        kind = np.unique(as_bytes, return_inverse=True)[1].ravel()
        order = np.lexsort((ids, kind))
        kind, x, ids = kind[order], x[order], ids[order]
        fresh = np.concatenate(([True], (kind[1:] != kind[:-1]) | (ids[1:] != ids[:-1])))
        kind, x, ids = kind[fresh], x[fresh], ids[fresh]
        head = np.concatenate(([True], kind[1:] != kind[:-1]))
        turn = np.arange(len(kind)) - np.flatnonzero(head)[np.cumsum(head) - 1]
        x, ids = x[turn <= k], ids[turn <= k]
        norm = (x * x).sum(axis=1)
        take = min(k + 1, len(x))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(q), 256):
            own = q[at:at + 256]
            mine = (own * own).sum(axis=1)[:, None]
            with np.errstate(over="ignore", invalid="ignore"):
                rough = mine + norm - 2 * own @ x.T
            rough = np.nan_to_num(rough, nan=0.0)
            limit = np.partition(rough, take - 1, axis=1)[:, take - 1:take]
            r, c = np.nonzero(rough <= limit + 1e-9 * (mine + norm.max()))  # rounding cannot hide a nearer row
            score = np.sqrt(((own[r] - x[c]) ** 2).sum(axis=1))
            o = np.lexsort((ids[c], score, r))
            r, c, score = r[o], c[o], score[o]
            start = np.searchsorted(r, np.arange(len(own)))
            good = np.arange(len(r)) - start[r] < take
            out.append((cls[at + r[good]], ids[c[good]], score[good]))
        a, b, s = (np.concatenate(z) for z in zip(*out, strict=True))
        return pa.table({"cls": a, "vec_id": b, "score": s})

    return run


def search(index: Index, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest indexed rows of each query (vec_id, v): query_id, rank, vec_id, score."""
    spark = queries.sparkSession
    if index.router is None:
        return spark.createDataFrame([], RESULT)
    distinct = handover(queries.groupBy("v").agg(F.min("vec_id").alias("cls")), "ann-queries")
    asked = handover(_routed(distinct, index.router, index.router.probes), "ann-asked")
    counted = lambda df, n: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias(n))
    # One row per part, at most MAX_PARTS.
    salts = F.broadcast(counted(index.rows, "blocks").join(counted(asked, "groups"), "part"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    rows = index.rows.join(salts, "part").select("part", one("vec_id", "blocks").alias("block"), every("groups").alias("group"), "vec_id", "v")
    wanted = asked.join(salts, "part").select("part", every("blocks").alias("block"), one("cls", "groups").alias("group"), "cls", "v")
    at = ["part", "block", "group"]
    near = rows.groupBy(*at).cogroup(wanted.groupBy(*at)).applyInArrow(_ranked_block(k), "cls long, vec_id long, score double")
    best = Window.partitionBy("cls").orderBy("score", "vec_id")
    lists = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("cls").agg(
        F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    # Ids that ask for the same vector differ only in the id they leave out.
    found = queries.distinct().join(distinct.join(lists, "cls").select("v", "near"), "v")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    return found.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = K) -> DataFrame:
    """The k nearest other rows of each row whose id is divisible by ``every``."""
    rows = usable_vectors(df, id_col, vector_col)
    return search(build_index(rows, k), rows.where(F.pmod("vec_id", F.lit(every)) == 0), k)
