"""K-Means whose result depends on the rows alone, not on how they are dealt (M3, M5, M6).

Rows with equal features are one point with a weight, so everything after the first aggregate runs
over distinct points. All random choices come from hashes of the row's id, and all sums are sums of
decimals, which are exact in any order: partitions, files and session settings change nothing.

Seeding is a bottom-k sample by hash priorities. A row's priority in a round is an exponential
variable made of its id's hash, divided by its squared distance from the centres found so far; the
smallest are taken, that is, rows with a chance in proportion to that distance. A point's priority is
the least of its rows', which one ``max`` per round keeps. The candidates of two rounds, weighed by
the points near them, seed every k by weighted k-means++ on the driver (a few dozen vectors).

A Lloyd step is one aggregate for all k at once; a k whose centres did not move is left out of the
next step. One more pass gives the silhouettes of all k from the distances to the clusters' means.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import Decimal, localcontext
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 2
ROUND_ROWS = 32  # candidates a round; the same for all k up to half of it, so a sweep seeds like single fits
EXACT = "decimal(30,14)"  # a term of an exact sum
DIGITS = 9  # of a scaled coordinate
MOVED = 10.0**-DIGITS  # a centre that moved by less stands still

Centres = list[list[float]]


# ---- points -----------------------------------------------------------------------------
def _uniform(id_col: str, seed: int, turn: int) -> Column:
    """A number in (0, 1) from the hash of an id."""
    return (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(turn)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def distinct_rows(df: DataFrame, features: Sequence[str], id_col: str, seed: int) -> DataFrame:
    """The distinct feature rows with their weight ``w`` and largest uniforms ``u0``, ``u1``, ..."""
    largest = [F.max(_uniform(id_col, seed, t)).alias(f"u{t}") for t in range(ROUNDS + 1)]
    return df.groupBy(*features).agg(F.count(F.lit(1)).alias("w"), *largest)


def exact_sum(term: Column) -> Column:
    """A sum that is the same in every order: terms are rounded to decimals first."""
    return F.sum(term.cast(EXACT))


def moments(rows: DataFrame, features: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Total weight, weighted mean and sample standard deviation of each feature."""
    value = lambda c: F.col(c).cast("double")
    sums = [exact_sum(value(c) * F.col("w")) for c in features] + [exact_sum(value(c) * value(c) * F.col("w")) for c in features]
    total, *got = rows.agg(F.sum("w"), *sums).first()
    n = int(total or 0)
    mean, std = [], []
    with localcontext() as ctx:
        ctx.prec = 60
        for s, s2 in zip(got[: len(features)], got[len(features):], strict=True):
            s, s2 = Decimal(s or 0), Decimal(s2 or 0)
            mean.append(float(s / n) if n else 0.0)
            var = (s2 - s * s / n) / (n - 1) if n > 1 else Decimal(0)
            # Terms are rounded at the 14th digit; less than that is no spread.
            std.append(math.sqrt(var) if var > Decimal("1e-13") else 0.0)
    return n, mean, std


# ---- expressions over a point's array x ---------------------------------------------------
def _number(v: float) -> str:
    return f"{float(v)!r}D"


def _vector(v: Sequence[float]) -> str:
    return f"array({', '.join(map(_number, v))})"


def _squared(x: str, c: str) -> str:
    return f"aggregate(zip_with({x}, {c}, (p, q) -> (p - q) * (p - q)), 0D, (s, t) -> s + t)"


def _nearest(centres: str, x: str = "x") -> str:
    """Smallest squared distance and its index; the lowest index on ties."""
    return f"array_min(transform({centres}, (c, j) -> named_struct('d', {_squared(x, 'c')}, 'j', j)))"


def _literal(centres: Sequence[Sequence[float]]) -> str:
    return f"array({', '.join(map(_vector, centres))})"


def constant(centres: Sequence[Sequence[float]]) -> Column:
    """The centres as an array of arrays."""
    return F.expr(_literal(centres))


# ---- seeding ----------------------------------------------------------------------------
def _candidates(points: DataFrame, most: int) -> Centres:
    """The first row by priority, then ``ROUND_ROWS`` (or ``2 * most``) rows a round."""
    found = [list(points.orderBy(F.desc("u0"), "x").select("x").first()["x"])]
    for turn in range(1, ROUNDS + 1):
        away = points.withColumn("d", F.expr(f"{_nearest(_literal(found))}.d")).where("d > 0")
        priority = -F.log(F.col(f"u{turn}")) / F.col("d")
        found += [list(r["x"]) for r in away.orderBy(priority, "x").select("x").limit(max(ROUND_ROWS, 2 * most)).collect()]
    return found


def _seeds(candidates: Centres, weight: np.ndarray, k: int, seed: int) -> Centres:
    """Weighted k-means++ over the candidates, best of eight by weighted cost."""
    x = np.array(candidates)
    best: tuple[float, list[int]] | None = None
    for turn in range(8):
        rng = np.random.default_rng([seed, k, turn])
        picked = [int(rng.choice(len(x), p=weight / weight.sum()))]
        d = ((x - x[picked[0]]) ** 2).sum(axis=1)
        while len(picked) < k:
            chance = weight * d
            if not chance.sum():
                chance = np.where(d > 0, 1.0, 0.0)
            picked.append(int(rng.choice(len(x), p=chance / chance.sum())))
            d = np.minimum(d, ((x - x[picked[-1]]) ** 2).sum(axis=1))
        cost = float((weight * d).sum())
        if best is None or cost < best[0]:
            best = (cost, picked)
    return [candidates[i] for i in best[1]]


def seed_centres(points: DataFrame, ks: Sequence[int], seed: int) -> dict[int, Centres]:
    """First centres of every k; ``points`` must hold at least max(ks) distinct vectors."""
    candidates = _candidates(points, max(ks))
    near = points.select("w", F.expr(f"{_nearest(_literal(candidates))}.j").alias("j")).groupBy("j").agg(F.sum("w").alias("w")).collect()
    weight = np.zeros(len(candidates))
    for r in near:
        weight[r["j"]] = float(r["w"])
    return {k: _seeds(candidates, weight, k, seed) for k in ks}


# ---- Lloyd steps for all k at once --------------------------------------------------------
@dataclass
class Fit:
    """Centres, and of the assignment to them: weights, means and spread per cluster, and the cost."""

    centres: Centres
    weights: list[int] = field(default_factory=list)
    means: Centres = field(default_factory=list)
    spread: list[float] = field(default_factory=list)
    cost: float = 0.0
    steps: int = 0
    settled: bool = False


def _models(fits: dict[int, Fit]) -> str:
    return f"array({', '.join(f'named_struct({chr(39)}k{chr(39)}, {k}, {chr(39)}c{chr(39)}, {_literal(f.centres)})' for k, f in fits.items())})"


def _measure(points: DataFrame, fits: dict[int, Fit]) -> None:
    """One aggregate over the points: the clusters of every fit in ``fits``."""
    width = len(next(iter(fits.values())).centres[0])
    every = F.expr(f"transform({_models(fits)}, m -> named_struct('k', m.k, 'b', {_nearest('m.c')}))")
    square = F.expr("aggregate(x, 0D, (s, t) -> s + t * t)")
    rows = points.select("x", "w", square.alias("xx"), F.explode(every).alias("e"))
    sums = [exact_sum(F.col("x")[i] * F.col("w")).alias(f"s{i}") for i in range(width)]
    got = rows.groupBy(F.col("e.k").alias("k"), F.col("e.b.j").alias("j")).agg(
        F.sum("w").alias("w"), exact_sum(F.col("xx") * F.col("w")).alias("xx"), exact_sum(F.col("e.b.d") * F.col("w")).alias("cost"), *sums).collect()
    for k, fit in fits.items():
        fit.weights, fit.means, fit.spread = [0] * k, [list(c) for c in fit.centres], [0.0] * k
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["j"])
        fit.cost = float(sum((r["cost"] for r in mine), Decimal(0)))
        for r in mine:
            n = int(r["w"])
            mean = [float(r[f"s{i}"] / n) for i in range(width)]
            fit.weights[r["j"]], fit.means[r["j"]] = n, mean
            fit.spread[r["j"]] = max(float(r["xx"] / n) - sum(v * v for v in mean), 0.0)


def fit_all(points: DataFrame, starts: dict[int, Centres], max_iter: int) -> dict[int, Fit]:
    """Lloyd's algorithm for every k from its start, all in the same passes.

    A cluster that loses all rows keeps its centre. After ``max_iter`` steps the last centres are
    measured once more, so that weights, means and cost always belong to the centres returned.
    """
    fits = {k: Fit([list(c) for c in start]) for k, start in starts.items()}
    for _ in range(max_iter):
        moving = {k: f for k, f in fits.items() if not f.settled}
        if not moving:
            return fits
        _measure(points, moving)
        for f in moving.values():
            f.steps += 1
            f.settled = all(abs(p - q) <= MOVED for new, old in zip(f.means, f.centres, strict=True) for p, q in zip(new, old, strict=True))
            f.centres = f.means
    moving = {k: f for k, f in fits.items() if not f.settled}
    if moving:
        _measure(points, moving)
    return fits


def silhouettes(points: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Mean silhouette of every fit in one pass; -1 where fewer than two clusters have rows.

    The mean squared distance of a point from a cluster is its squared distance from the cluster's
    mean plus the cluster's spread.
    """
    good = {k: f for k, f in fits.items() if sum(n > 0 for n in f.weights) > 1}
    if good:
        clusters = lambda f: ", ".join(
            f"named_struct('j', {j}, 'n', {n}L, 'v', {_number(v)}, 'm', {_vector(m)})"
            for j, (n, v, m) in enumerate(zip(f.weights, f.spread, f.means, strict=True)) if n)
        models = ", ".join(f"named_struct('k', {k}, 'c', {_literal(f.centres)}, 'l', array({clusters(f)}))" for k, f in good.items())
        rows = points.select("x", "w", F.explode(F.expr(f"array({models})")).alias("m"))
        rows = rows.withColumn("own", F.expr(f"{_nearest('m.c')}.j")).withColumn(
            "far", F.expr(f"transform(m.l, l -> named_struct('j', l.j, 'n', l.n, 'd', {_squared('x', 'l.m')} + l.v))"))
        own = F.expr("filter(far, f -> f.j = own)[0]")
        a = own["d"] * own["n"] / F.greatest(own["n"] - 1, F.lit(1))
        b = F.expr("array_min(transform(filter(far, f -> f.j <> own), f -> f.d))")
        top = F.greatest(a, b)
        s = F.when((own["n"] == 1) | (top <= 0), 0.0).otherwise((b - a) / top)
        got = rows.groupBy(F.col("m.k").alias("k")).agg((exact_sum(s * F.col("w"))).alias("s"), F.sum("w").alias("w")).collect()
        score = {r["k"]: float(r["s"] / r["w"]) for r in got}
    else:
        score = {}
    return {k: score.get(k, -1.0) for k in fits}


def matched(new: Centres, old: Centres) -> Centres:
    """``new`` in the order of the nearest ``old`` centres, closest pairs first; others follow."""
    d = sorted((sum((p - q) ** 2 for p, q in zip(a, b, strict=True)), j, i) for i, a in enumerate(new) for j, b in enumerate(old))
    place: dict[int, int] = {}
    taken: set[int] = set()
    for _, j, i in d:
        if i not in place and j not in taken and j < len(new):
            place[i] = j
            taken.add(j)
    free = [j for j in range(len(new)) if j not in taken]
    for i in range(len(new)):
        if i not in place:
            place[i] = free.pop(0)
    return [c for _, c in sorted(zip([place[i] for i in range(len(new))], new, strict=True))]
