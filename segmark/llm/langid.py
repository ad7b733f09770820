"""Language ID by interpolated Kneser-Ney character models held in sorted hash arrays.

Text is cut into words of letters, each between a start and an end symbol. Counts of the
longest character n-gram at each position come from all training rows, summed per distinct
word inside a task and then by a partial aggregate; every lower order follows from them as
continuation counts. A language's model is its interpolated probabilities and back-off
weights; discounts, continuation counts and probabilities are Spark aggregates and joins over all
n-grams and end in a written table. Its n-grams share one sorted array of 64-bit hashes per order,
with a (language, value) entry for each language that has the n-gram, and a text is scored by
binary search, one look-up per distinct word and position.

The language with the lowest cross-entropy per symbol wins. A text is rejected if that
cross-entropy lies beyond the calibrated limit of the language: half-way to the closest other
language's text under the same model, plus three standard errors for the text's length.
All counts are scored for it in Spark, by the scorer that is used.

The model holds every n-gram and grows with the number of distinct ones: 12 bytes an entry of a
language and 16 a distinct n-gram, in the driver and in each worker. A caller may bound the scorer
by ``max_grams``: each language then keeps its n-grams with a count of at least 2^b, b the least
that fits its share; their probabilities and the rejection limits still come from all counts.

Defined results: a null text or one without a letter is ``und``, score 0, rejected. With no
training row every text is ``und``. Ties go to the language first in order. Repeated rows and
null ids keep their rows. Input columns named like a result column are replaced.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmark.llm.common import handover, without
from segmark.llm.textblocks import ALNUM, Block, blocks, scrambled, words

ORDER = 4
START, END = "\x02", "\x03"
UNKNOWN = "und"
SHARPNESS = 8.0  # of the softmax over cross-entropies per symbol

_NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_DIGIT = regex.compile(r"\p{N}")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters(vocabulary: list[bytes]) -> tuple[list[str], np.ndarray]:
    """The lower-cased letters of each word (or an empty string), and whether it mixes them with digits.

    Mixed words are codes and keys more often than language; they count only for texts that
    have no other letters.
    """
    out, mixed = [], np.zeros(len(vocabulary), bool)
    for i, v in enumerate(vocabulary):
        s = v.decode()
        if not (v.isalpha() or s.isalpha()):
            mixed[i] = _DIGIT.search(s) is not None
            s = _NO_LETTER.sub("", s)
            if not _LETTER.search(s):
                s = ""
        out.append(s if v.isascii() else s.lower())
    return out, mixed


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all bracketed words and the offset of each word."""
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    flat = "".join(f"{START}{t}{END}" for t in texts)
    return np.frombuffer(flat.encode("utf-32-le"), np.uint32), np.concatenate(([0], np.cumsum(size)))


def _ending_hashes(symbols: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order, the hash of the k symbols that end at each position (wrapping at the front)."""
    value = scrambled(symbols)
    out, power = [value], np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(1, order):
            power = power * _STEP
            out.append(out[-1] + np.roll(value, k) * power)
    return out


def gram_counts(rows: DataFrame, lang_col: str, text_col: str, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each longest n-gram occurs in the rows of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches, "_text"):
            w = words(block.lowered(), ALNUM)
            code, vocabulary = w.coded
            text, mixed = letters(vocabulary.to_pylist())
            symbols, off = _symbols(text)
            alphabet, small = np.unique(symbols, return_inverse=True)
            width = max(1, int(len(alphabet)).bit_length())
            place = np.arange(len(symbols)) - np.repeat(off[:-1], np.diff(off))
            gram = np.zeros(len(symbols), np.uint64)
            for k in range(order):  # code 0 stands for "before the word"
                part = np.where(place >= k, np.roll(small, k) + 1, 0).astype(np.uint64)
                gram |= part << np.uint64(width * k)
            scored = place > 0
            owner = np.repeat(np.arange(len(text)), np.diff(off))[scored]
            distinct, at = np.unique(gram[scored], return_inverse=True)
            spelled = [np.array([""] + [chr(c) for c in alphabet])[((distinct >> np.uint64(width * k)) & np.uint64((1 << width) - 1)).astype(np.int64)]
                       for k in reversed(range(order))]
            name = spelled[0]
            for s in spelled[1:]:
                name = np.char.add(name, s)
            lang = batch.column("_lang").dictionary_encode()
            doc_lang = lang.indices.to_numpy(zero_copy_only=False)
            empty = mixed | np.array([not t for t in text], bool)
            for i, value in enumerate(lang.dictionary.to_pylist()):
                own = np.bincount(code[doc_lang[w.doc] == i], minlength=len(text))
                own[empty] = 0
                n = np.bincount(at, weights=own[owner], minlength=len(distinct)).astype(np.int64)
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value] * len(seen), pa.string()), pa.array(name[seen].tolist(), pa.string()), pa.array(n[seen])],
                    names=["lang", "gram", "n"])

    if order * 16 > 64:
        raise ValueError("n-grams of more than four symbols do not fit a 64-bit code")
    known = rows.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    counted = known.mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def largest_model(counts: DataFrame, max_grams: int) -> DataFrame:
    """``counts`` without the rarest n-grams of languages beyond their share of the model."""
    scale = F.floor(F.log2("n")).cast("int")
    tiers = counts.groupBy("lang", scale.alias("tier")).agg(F.count(F.lit(1)).alias("k"))  # at most 63 rows a language
    upto = tiers.select("lang", "tier", F.sum("k").over(
        Window.partitionBy("lang").orderBy(F.desc("tier"))).alias("kept"))
    share = max_grams // max(1, tiers.select("lang").distinct().count())
    least = upto.groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("kept") <= share, F.col("tier"))), F.max("tier")).alias("least"))
    return counts.join(F.broadcast(least), "lang").where(scale >= F.col("least")).drop("least")


#: Where the entries of each key start, and the language and value of each entry.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class CharModels:
    """Sorted hash arrays per order with the log probabilities or back-off weights of the languages that have the key."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[Entries]
    context_keys: list[np.ndarray]
    backoff: list[Entries]
    floor: np.ndarray
    limit: np.ndarray  # largest expected cross-entropy per language
    spread: np.ndarray  # standard deviation per symbol

    @property
    def order(self) -> int:
        return len(self.keys)

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word under each language, and its number of scored symbols."""
        symbols, off = _symbols(texts)
        n = np.diff(off) - 1
        if not len(symbols):
            return np.zeros((0, len(self.langs))), n
        hashes = _ending_hashes(symbols, self.order)
        place = np.arange(len(symbols)) - np.repeat(off[:-1], n + 1)
        # A position's score depends on the last symbols of its word alone: score each such run once.
        run = np.choose(np.minimum(place, self.order - 1), hashes)
        _, one, at = np.unique(run, return_index=True, return_inverse=True)
        score = self._positions([h[one] for h in hashes], [h[one - 1] for h in hashes], place[one])
        score[place[one] == 0] = 0.0
        return np.stack([np.add.reduceat(score[at, i], off[:-1]) for i in range(len(self.langs))], axis=1), n

    def _positions(self, ending: list[np.ndarray], before: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        score = np.full((len(place), len(self.langs)), np.nan)
        weight = np.zeros_like(score)
        for k in range(self.order, 0, -1):
            at = np.flatnonzero((place >= max(1, k - 1)) & np.isnan(score).any(axis=1))
            found = _rows_of(self.keys[k - 1], self.logp[k - 1], ending[k - 1][at], np.nan, len(self.langs))
            fresh = np.isnan(score[at]) & ~np.isnan(found)
            score[at] = np.where(fresh, found + weight[at], score[at])
            if k > 1:
                weight[at] += _rows_of(self.context_keys[k - 1], self.backoff[k - 1], before[k - 2][at], 0.0, len(self.langs))
        return np.where(np.isnan(score), weight + self.floor, score)

    def classify(self, block: Block) -> dict[str, np.ndarray]:
        """Per document: language index (-1: none), score, cross-entropy and whether it is rejected."""
        w = words(block.lowered(), ALNUM)
        n_docs, n_langs = len(block), len(self.langs)
        best, size = np.full(n_docs, -1), np.zeros(n_docs)
        score, entropy = np.zeros(n_docs), np.full(n_docs, np.nan)
        if len(w) and n_langs:
            code, vocabulary = w.coded
            text, mixed = letters(vocabulary.to_pylist())
            value, n = self.word_scores(text)
            blank = np.array([not t for t in text], bool)
            value[blank], n[blank] = 0.0, 0
            per_doc = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[w.first])
            plain = np.where(mixed, 0, n)
            use = ~mixed[code] | (per_doc(plain[code]) == 0)[w.doc]
            total = np.stack([per_doc(np.where(use, value[code, i], 0.0)) for i in range(n_langs)], axis=1)
            symbols = size = per_doc(np.where(use, n[code], 0))
            has = symbols > 0
            ce = -total[has] / symbols[has, None]
            best[has] = ce.argmin(axis=1)
            low = ce.min(axis=1)
            score[has] = 1.0 / np.exp(-SHARPNESS * (ce - low[:, None])).sum(axis=1)
            entropy[has] = low
        i = np.maximum(best, 0)
        with np.errstate(invalid="ignore", divide="ignore"):
            rejected = (best < 0) | (entropy > (self.limit[i] + 3 * self.spread[i] / np.sqrt(size) if n_langs else 0))
        return {"best": best, "score": score, "entropy": entropy, "rejected": rejected}


def _rows_of(keys: np.ndarray, entries: Entries, asked: np.ndarray, missing: float, n_langs: int) -> np.ndarray:
    out = np.full((len(asked), n_langs), missing)
    if len(keys):
        first, lang, value = entries
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == asked)
        size = first[at[hit] + 1] - first[at[hit]]
        row = np.repeat(hit, size)
        entry = np.arange(len(row)) + np.repeat(first[at[hit]] - np.cumsum(size) + size, size)
        out[row, lang[entry]] = value[entry]
    return out


def _packed(key: np.ndarray, lang: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, Entries]:
    """Distinct sorted keys, and the entries of each."""
    order = np.lexsort((lang, key))
    keys, first = np.unique(key[order], return_index=True)
    return keys, (np.append(first, len(key)).astype(np.int64), lang[order].astype(np.int32), value[order].astype(np.float64))


def _one_language(counts: dict[str, int], order: int) -> tuple[list[dict[str, float]], list[dict[str, float]], float]:
    """Log probabilities and log back-off weights per order, and the log probability of a new symbol."""
    adjusted: list[dict[str, int]] = [{} for _ in range(order + 1)]
    for g, n in counts.items():
        adjusted[len(g)][g] = adjusted[len(g)].get(g, 0) + n
    for k in range(order - 1, 0, -1):  # continuation counts; n-grams at a word's start keep raw counts
        lower = adjusted[k]
        for g in adjusted[k + 1]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
    logp: list[dict[str, float]] = [{}]
    weight: list[dict[str, float]] = [{}]
    uniform = 1.0 / (len(adjusted[1]) + 1)
    base = uniform
    for k in range(1, order + 1):
        c = adjusted[k]
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
        total: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for g, n in c.items():
            h = g[:-1]
            total[h] = total.get(h, 0) + n
            kinds[h] = kinds.get(h, 0) + 1
        gamma = {h: d * kinds[h] / total[h] for h in total}
        if k == 1:
            base = gamma.get("", 1.0) * uniform
        prob = {g: (n - d) / total[g[:-1]] + gamma[g[:-1]] * (np.exp(logp[k - 1][g[1:]]) if k > 1 else uniform) for g, n in c.items()}
        logp.append({g: float(np.log(p)) for g, p in prob.items()})
        weight.append({h: float(np.log(v)) for h, v in gamma.items()})
    return logp, weight, float(np.log(base))


def _hash_grams(grams: list[str]) -> np.ndarray:
    k = len(grams[0])
    symbols = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
    return _ending_hashes(symbols, k)[k - 1][k - 1::k]


def _merge(per_lang: list[dict[str, float]]) -> tuple[np.ndarray, Entries]:
    grams = [g for d in per_lang for g in d]
    key = _hash_grams(grams) if grams else np.zeros(0, np.uint64)
    return _packed(key, np.repeat(np.arange(len(per_lang)), [len(d) for d in per_lang]), np.array([v for d in per_lang for v in d.values()]))


def _assembled(langs: list[str], grams: list[tuple[np.ndarray, Entries]], contexts: list[tuple[np.ndarray, Entries]], floor: np.ndarray) -> CharModels:
    none = _packed(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0))
    contexts = [none, *contexts]  # a single symbol has no context
    return CharModels(langs, [g[0] for g in grams], [g[1] for g in grams], [c[0] for c in contexts], [c[1] for c in contexts],
                      floor, np.zeros(len(langs)), np.zeros(len(langs)))


def _text_score(models: CharModels, grams: list[str], n: np.ndarray) -> np.ndarray:
    """Summed n, cross-entropy and its square under each model, of n-grams that occur n times each."""
    out, size = np.zeros((3, len(models.langs))), np.fromiter(map(len, grams), np.int64, len(grams))
    out[0] = n.sum()
    for k in np.unique(size).tolist():
        some = np.flatnonzero(size == k)
        symbols = np.frombuffer("".join(grams[i] for i in some).encode("utf-32-le"), np.uint32)
        h = _ending_hashes(np.pad(symbols, (0, models.order)), models.order)
        last = np.arange(k - 1, len(symbols), k)
        value = -models._positions([x[last] for x in h], [x[last - 1] for x in h], np.full(len(last), k - 1))
        weight = n[some].astype(float)[:, None]
        out[1] += (weight * value).sum(axis=0)
        out[2] += (weight * value**2).sum(axis=0)
    return out


def _calibrate(models: CharModels, scored: np.ndarray) -> CharModels:
    """Set the limits from ``scored``: per language of the text, the sums of ``_text_score``."""
    langs = models.langs
    if langs:
        mean, second = scored[:, 1] / scored[:, 0], scored[:, 2] / scored[:, 0]  # [text, model]
        own = np.diag(mean)
        gap = np.where(np.eye(len(langs), dtype=bool), np.inf, mean - own[None, :])
        nearest = np.where(np.isfinite(gap.min(axis=0)), gap.min(axis=0), 2.0)
        models.limit = own + np.maximum(0.5 * nearest, 0.25)
        models.spread = np.sqrt(np.maximum(np.diag(second) - own**2, 0.0))
    return models


def build_models(counts: dict[str, dict[str, int]], order: int = ORDER) -> CharModels:
    """Models and rejection limits from n-gram counts in memory: what ``fit`` computes in Spark."""
    langs = sorted(counts)
    parts = [_one_language(counts[name], order) for name in langs]
    models = _assembled(langs, [_merge([p[0][k] for p in parts]) for k in range(1, order + 1)],
                        [_merge([p[1][k] for p in parts]) for k in range(2, order + 1)], np.array([p[2] for p in parts]))
    return _calibrate(models, np.array([_text_score(models, list(counts[x]), np.array(list(counts[x].values()))) for x in langs]))


def _levels(counts: DataFrame, order: int, value: str) -> dict[int, DataFrame]:
    """Per length k, the n-grams (lang, gram) of ``counts`` and of the ends of longer ones, with ``value`` as n."""
    levels: dict[int, DataFrame] = {}
    for k in range(order, 0, -1):
        own = counts.where(F.length("gram") == k).select("lang", "gram", "n")
        if k < order:  # continuation counts; n-grams at a word's start keep raw counts
            ends = levels[k + 1].select("lang", F.substring("gram", 2, k).alias("gram"), F.lit(1).cast("bigint").alias("n"))
            own = handover(own.unionByName(ends).groupBy("lang", "gram").agg(F.expr(value).alias("n")), "char-level")
        levels[k] = own
    return levels


def model_tables(counts: DataFrame, order: int = ORDER, max_grams: int | None = None) -> tuple[list[str], np.ndarray, list[DataFrame], list[DataFrame]]:
    """Languages, log probability of a new symbol, and per order (lang, gram, value): probabilities and back-off weights.

    All of it is computed over all n-grams; ``max_grams`` only picks rows.
    """
    spark = counts.sparkSession
    levels = _levels(counts, order, "sum(n)")
    seen = reduce(DataFrame.unionByName, [levels[k].groupBy("lang").agg(
        F.lit(k).alias("k"), F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice")) for k in levels]).collect()  # a row per language and order
    discount = {(r.lang, r.k): min(0.9, max(0.1, r.once / (r.once + 2 * r.twice))) if r.once + r.twice else 0.5 for r in seen}
    uniform = {r.lang: 1.0 / (r.kinds + 1) for r in seen if r.k == 1}
    langs = sorted(uniform)
    if not langs:
        return [], np.zeros(0), [], []
    kept = _levels(largest_model(counts, max_grams), order, "max(n)") if max_grams is not None else {}
    floor = np.zeros(len(langs))
    grams, contexts, lower = [], [], None
    for k in range(1, order + 1):
        rates = F.broadcast(spark.createDataFrame([(x, discount.get((x, k), 0.5), uniform[x]) for x in langs], "lang string, d double, uniform double"))
        split = levels[k].withColumn("h", F.substring("gram", 1, k - 1))
        context = handover(split.groupBy("lang", "h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).join(rates, "lang").select(
            "lang", "h", "total", "d", "uniform", (F.col("d") * F.col("kinds") / F.col("total")).alias("gamma")), "char-contexts")
        if lower is None:  # one context a language
            known = split.join(F.broadcast(context), ["lang", "h"]).withColumn("below", F.col("uniform"))
            for r in context.collect():
                floor[langs.index(r.lang)] = np.log(r.gamma * r.uniform)
        else:
            known = split.join(context, ["lang", "h"]).withColumn("end", F.substring("gram", 2, k - 1)).join(
                lower.select("lang", F.col("gram").alias("end"), F.col("p").alias("below")), ["lang", "end"])
        lower = handover(known.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")).alias("p")), "char-model")
        own, back = lower, context
        if kept:
            own = own.join(kept[k].select("lang", "gram"), ["lang", "gram"], "left_semi")
            back = back.join(kept[k].select("lang", F.substring("gram", 1, k - 1).alias("h")), ["lang", "h"], "left_semi")
        grams.append(own.select("lang", "gram", F.log("p").alias("value")))
        if k > 1:
            contexts.append(back.select("lang", F.col("h").alias("gram"), F.log("gamma").alias("value")))
    return langs, floor, grams, contexts


def _hashed_table(table: DataFrame, langs: list[str]) -> tuple[np.ndarray, Entries]:
    """``table`` (n-grams of one length) written sorted by hash, and gathered as packed arrays."""
    number = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = pa.array([number[x] for x in batch.column("lang").to_pylist()], pa.int32())
                key = pa.array(_hash_grams(batch.column("gram").to_pylist()).view(np.int64))
                yield pa.RecordBatch.from_arrays([key, code, batch.column("value")], names=["key", "lang", "value"])

    hashed = table.mapInArrow(run, "key long, lang int, value double").sortWithinPartitions("key")
    got = handover(hashed, "char-hashes").toArrow()
    return _packed(got.column("key").to_numpy().view(np.uint64), got.column("lang").to_numpy(), got.column("value").to_numpy())


def _scores_of_all(counts: DataFrame, models: CharModels) -> np.ndarray:
    """Per language of the text, the sums of ``_text_score`` over all of ``counts``."""
    shared = counts.sparkSession.sparkContext.broadcast(vars(models))
    n_langs = len(models.langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CharModels(**shared.value)
        sums = {}
        for batch in batches:
            lang, n = np.array(batch.column("lang").to_pylist(), object), batch.column("n").to_numpy()
            grams = batch.column("gram").to_pylist()
            for name in set(lang.tolist()):
                at = np.flatnonzero(lang == name)
                sums[name] = sums.get(name, 0.0) + _text_score(own, [grams[i] for i in at], n[at])
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * n_langs, pa.string()), pa.array(np.arange(n_langs, dtype=np.int32)), *map(pa.array, total)],
                                             names=["lang", "model", "n", "s", "q"])

    out = np.zeros((n_langs, 3, n_langs))
    summed = counts.mapInArrow(run, "lang string, model int, n double, s double, q double").groupBy("lang", "model").agg(F.sum("n"), F.sum("s"), F.sum("q"))
    for lang, model, *sums in summed.collect():
        out[models.langs.index(lang), :, model] = sums
    return out


def held_out(id_col: str) -> F.Column:
    """crc32 of the id as text is a multiple of five; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", max_grams: int | None = None, order: int = ORDER) -> CharModels:
    """Models of the languages of ``rows``, of all n-grams or of about ``max_grams``."""
    counts = handover(gram_counts(rows, lang_col, text_col, order), "char-grams")
    langs, floor, grams, contexts = model_tables(counts, order, max_grams)
    if not langs:
        return build_models({}, order)
    models = _assembled(langs, [_hashed_table(t, langs) for t in grams], [_hashed_table(t, langs) for t in contexts], floor)
    return _calibrate(models, _scores_of_all(counts, models))


def identify(df: DataFrame, models: CharModels, text_col: str = "text") -> DataFrame:
    """``df`` plus lang_pred, score (0 to 1), cross_entropy and rejected."""
    rows = without(df, {"lang_pred", "score", "cross_entropy", "rejected"} - {text_col.lower()})
    shared = df.sparkSession.sparkContext.broadcast(vars(models))  # plain arrays: workers need not import this module
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CharModels(**shared.value)
        names = np.array([*own.langs, UNKNOWN], object)
        for batch, block in blocks(batches, text_col):
            r = own.classify(block)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[r["best"]], pa.string()), pa.array(r["score"]),
                 pa.array(r["entropy"], mask=np.isnan(r["entropy"])), pa.array(r["rejected"])],
                names=[*batch.schema.names, "lang_pred", "score", "cross_entropy", "rejected"])

    return rows.mapInArrow(run, schema)


def identify_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` plus held_out and the prediction of models learned from its rows that are not held out."""
    models = fit(df.where(~held_out(id_col)), lang_col, text_col)
    return identify(without(df, ["held_out"]).withColumn("held_out", held_out(id_col)), models, text_col)


def drop_rejected(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text is accepted as some language, unchanged."""
    models = fit(df.where(~held_out(id_col)), lang_col, text_col)
    judged = identify(df.select(*[F.col(f"`{c}`").alias(f"in_{i}") if c != text_col else F.col(c).alias("in_text") for i, c in enumerate(df.columns)]),
                      models, "in_text")
    names = ["in_text" if c == text_col else f"in_{i}" for i, c in enumerate(df.columns)]
    return judged.where(~F.col("rejected")).select(*[F.col(n).alias(c) for n, c in zip(names, df.columns, strict=True)])
