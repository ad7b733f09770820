"""Fuzzy line dedup (native): MinHash banding, exact Jaccard verification, union-find.

A line is lower-cased and trimmed. Its shingles are ``SHINGLE`` characters long; one begins at
each word (it may be shorter at the line's end) and one at every character of a run of more than
eight characters without a blank, so that lines without blanks are compared at every offset.
The top bits of a shingle's hash name its band; the ``PER_BAND`` least hashes of a band are its key.
Short lines use fewer, wider bands. Two lines of Jaccard 0.8 or more over their shingles share a band
with a probability of about 0.96 or more.

Equal lines collapse before the shuffle. In a small bucket all pairs are compared, in a larger one all
members with a few pivots, and union-find joins what is linked: linear in the buckets' members, it
settles small buckets and groups of near copies. Pairs are first judged by their sets' sizes and
tallies (shingles per 32nd of the hash space), which come with the keys and rule out most pairs for
certain; only lines of the rest are read again, compared by bitmaps and then by the exact Jaccard of
their sets. Buckets that still hold several components are compared in full, tallies first, up to
``BLOCK`` lines; lines of wider ones meet on the rare shingles of their prefixes: two sets of Jaccard
0.8 or more share one of the first n - ceil(0.8 n) + 1 shingles of each in any common order. A bounded
sample tells which shingles come last; it decides the number of meetings only. Large meetings are
split into salted blocks. So every link between lines that share a bucket is found, none is left to
chance; only pairs that share no bucket can be missed.

The line of a component that stays is the one with the smallest (id, line number). Only
built-in column functions are used.

Defined results: a null text has no lines and stays null. Lines without a visible character
always stay and are never compared. Rows are numbered, so repeated rows and rows that share an id, or
have none, are rows of their own; null ids come after all others. Input columns named like a result column are
replaced. Empty tables give empty results.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmark.llm.common import handover, release, without
from segmark.llm.components import connected_components

SHINGLE = 9
SIMILARITY = 0.8
BINS = 32
BINS_SHIFT = 59  # a bin is named by the top five bits of a hash
PER_BAND = 4  # least shingles of a band that make its key
TALLIES = BINS // 8  # longs of a line's tallies
TALLIED = ["size", *[f"t{i}" for i in range(TALLIES)]]
PIVOTS = 4  # of a bucket: at most so many comparisons per member
# Of a long: its even bytes, and a one above each of them, which a subtraction byte by byte may borrow.
EVEN, BORROW = 0x00FF00FF00FF00FF, 0x0100010001000100
SMALL = 2 * PIVOTS  # lines of a bucket that are compared in full at once, as cheap as with pivots
MARKS = 4  # longs of a line's bitmap
BLOCK = 256  # lines of an open bucket compared in full; of one rare shingle that one salt compares with the others
SAMPLE = 1024  # open lines whose shingles tell common from rare ones
FILTER_BITS = 20  # of the broadcast pre-filter: at most a million small rows
BLANK = " \t\r\x0b\x0c"

# At a word's start up to SHINGLE characters, elsewhere exactly as many; short words are passed whole. The last
# word is not, but no shingle begins inside it.
_SHINGLES = rf"(?s)(?=({'.' * SHINGLE}|(?<!\S).{{1,{SHINGLE - 1}}}))(?:(?<!\S)\S{{1,{SHINGLE - 1}}}+\s++|\S\s*+)"


def _normal(line: Column) -> Column:
    return F.btrim(F.lower(line), F.lit(BLANK))


def _lines(rows: DataFrame) -> DataFrame:
    """id, row, no and the normal form of every visible line of numbered rows."""
    every = rows.select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("no", "raw"))
    return every.select("id", "row", "no", _normal(F.col("raw")).alias("line")).where(F.col("line") != "")


def _hashed(line: Column) -> Column:
    """64-bit hashes of a normal line's shingles, sorted; repeated shingles repeat."""
    found = F.regexp_extract_all(line, F.lit(_SHINGLES), F.lit(1))
    return F.sort_array(F.transform(found, lambda x: F.xxhash64(x)))


def shingles(line: Column) -> Column:
    """The distinct 64-bit hashes of a normal line's shingles."""
    return F.array_distinct(_hashed(line))


def _binned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``below``: per bin the number of hashes of ``s`` (sorted) in lower ones, and at last of all.

    The least hash of each of the 32 bins is put in once more, and its first place is searched for, in the
    half of the hashes it belongs to.
    """
    half = BINS // 2
    least = [F.lit((j - half) << BINS_SHIFT).cast("bigint") for j in range(BINS)]
    marked = rows.withColumn("bins", F.sort_array(F.concat("s", F.array(*least))))
    marked = marked.withColumn("to", F.array_position("bins", least[half]).cast("int"))
    marked = marked.withColumns({"low": F.slice("bins", F.lit(1), F.col("to")), "high": F.slice("bins", F.col("to"), F.size("bins"))})
    first = [F.array_position("low" if j < half else "high", x) - F.lit(j + 1) for j, x in enumerate(least)]
    low, high = F.array(*first[:half]), F.array(*[F.col("to") - F.lit(1) + x for x in first[half:]])
    return marked.select(*rows.columns, F.concat(low, high, F.array(F.size("s").cast("bigint"))).cast("array<int>").alias("below"))


def _band_keys(s: Column, below: Column) -> Column:
    """Bucket keys of sorted distinct shingles: one per band that has any, of its ``PER_BAND`` least.

    The number of shingles picks the number of bands: 2, 4 or 8. Lines near a limit use both
    numbers, so that a similar line just beyond it shares a kind of band with them. The lambda, over
    a null alone, keeps the rest out of whole-stage code, whose one method would be too long for the JIT compiler.
    """
    def bands(bits: int) -> Column:
        wide, at = BINS >> bits, lambda i: F.get(below, F.lit(i))
        return F.array(*[F.when(at(i + wide) > at(i), F.xxhash64(F.lit(bits), F.slice(
            s, at(i) + 1, F.least(F.lit(PER_BAND), at(i + wide) - at(i))))) for i in range(0, BINS, wide)])

    m, none = F.size(s), F.array().cast("array<bigint>")
    every = F.concat(F.when(m <= 6, bands(1)).otherwise(none), F.when((m >= 4) & (m <= 14), bands(2)).otherwise(none),
                     F.when(m >= 9, bands(3)).otherwise(none))
    return F.array_except(every, F.transform(F.array(F.when(m < 0, m).cast("bigint")), lambda x: x))


def _tallies(below: Column) -> list[Column]:
    """The number of shingles in each bin (at most 127), a byte each in ``TALLIES`` longs t0.."""
    counts = [F.least(F.get(below, F.lit(i + 1)) - F.get(below, F.lit(i)), F.lit(127)).cast("bigint") for i in range(BINS)]
    out = []
    for i in range(TALLIES):
        eight = [F.shiftleft(c, 8 * j) for j, c in enumerate(counts[8 * i:8 * i + 8])]
        out.append(sum(eight[1:], eight[0]).alias(f"t{i}"))
    return out


def distinct_lines(rows: DataFrame) -> DataFrame:
    """Per distinct normal line: h, its first place (id, row, no), its bucket keys, set size and tallies."""
    lines = _lines(rows)
    hashed = lines.select(
        F.xxhash64("line").alias("h"), F.hash("line").alias("h2"),
        F.struct(F.col("id").isNull().alias("last"), "id", "row", "no").alias("place"), shingles(F.col("line")).alias("s"))
    keyed = _binned(hashed).select("h", "h2", "place", _band_keys(F.col("s"), F.col("below")).alias("keys"), F.size("s").alias("size"),
                          *_tallies(F.col("below")))
    return keyed.groupBy("h", "h2").agg(F.min("place").alias("place"), *[F.first(c).alias(c) for c in ["keys", *TALLIED]])


def _shared_buckets(lines: DataFrame) -> DataFrame:
    """(k, h, n) of the buckets with n > 1 lines."""
    rows = lines.select(F.explode("keys").alias("k"), "h")
    return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")).cast("int")).where(F.col("n") > 1)


def _likely(rows: DataFrame, wanted: DataFrame, *key: str, how: str = "left_semi") -> DataFrame:
    """``rows`` whose key may be in ``wanted``, or with ``left_anti`` those whose key is not, unshuffled.

    A broadcast of the top bits of the wanted keys' hashes, at most 2^20 of them whatever the input, tells
    them apart: every wanted row is likely, and few others are while the wanted keys are fewer than those bits.
    """
    top = F.shiftrightunsigned(F.xxhash64(*key), 64 - FILTER_BITS)
    return rows.withColumn("top", top).join(F.broadcast(wanted.select(top.alias("top")).distinct()), "top", how).drop("top")


def _shingle_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, s) of the ``wanted`` lines (h, place; each h once), read again from the texts.

    Most other lines go before the shuffle; only wanted lines are lower-cased and cut up.
    """
    at = wanted.select("h", F.col("place.row").alias("row"), F.col("place.no").alias("no"))
    every = rows.select("row", F.posexplode(F.split("text", "\n", -1)).alias("no", "raw"))
    near = _likely(every, at, "row", "no")
    return near.join(at, ["row", "no"]).select("h", shingles(_normal(F.col("raw"))).alias("s"))


def _may_link(na: Column, nb: Column, similarity: float) -> Column:
    """Sets of these sizes can have that Jaccard at all."""
    return F.least(na, nb) >= F.lit(similarity) * F.greatest(na, nb) - F.lit(1e-6)


def _bitmaps(sets: DataFrame) -> DataFrame:
    """(h, size, m0..) of ``sets``: their sizes and their shingles as a bitmap of ``MARKS`` longs.

    The low bits of a shingle's hash choose its bit.
    """
    bits = [F.expr(f"aggregate(s, 0L, (m, x) -> if((x >> 6 & {MARKS - 1}) = {j}, m | (1L << cast(x & 63 as int)), m))").alias(f"m{j}") for j in range(MARKS)]
    return sets.select("h", F.size("s").alias("size"), *bits)


def _marked(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(k, h) of ``buckets`` with the bitmaps of their lines."""
    return buckets.select("k", "h").join(_bitmaps(sets), "h")


def _end(rows: DataFrame, end: str) -> DataFrame:
    """Marked rows as one end of pairs."""
    return rows.select("k", F.col("h").alias(end), F.col("size").alias(f"n{end}"), *[F.col(f"m{j}").alias(f"{end}{j}") for j in range(MARKS)])


def _possible(similarity: float) -> Column:
    """Sizes and bitmaps of the ends a and b leave the Jaccard possible.

    Each bit that one set has and the other lacks stands for at least one shingle that is not shared.
    """
    def alone(p: str, q: str) -> Column:
        lacks = [F.bit_count(F.col(f"{p}{j}").bitwiseAND(F.bitwise_not(F.col(f"{q}{j}")))) for j in range(MARKS)]
        return sum(lacks[1:], lacks[0])

    shared = F.least(F.col("na") - alone("a", "b"), F.col("nb") - alone("b", "a"))
    return _may_link(F.col("na"), F.col("nb"), similarity) & (
        shared >= F.lit(similarity / (1 + similarity)) * (F.col("na") + F.col("nb")) - F.lit(1e-6))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct ``pairs`` (a, b) whose sets have the Jaccard."""
    left = sets.select(F.col("h").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("h").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(both >= F.lit(similarity) * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _tallied(buckets: DataFrame, described: DataFrame) -> DataFrame:
    """(k, h, n) with the set size and tallies of each line."""
    own = described.groupBy("h").agg(*[F.first(c).alias(c) for c in TALLIED])
    return buckets.select("k", "h", "n").join(own, "h")


def _side(rows: DataFrame, end: str, *others: str) -> DataFrame:
    """Tallied rows as one end of pairs; sizes and tallies are known never to be null, which shortens the code that compares them."""
    tallied = {f"n{end}": F.coalesce("size", F.lit(0))} | {f"{end}{i}": F.coalesce(f"t{i}", F.lit(0).cast("bigint")) for i in range(TALLIES)}
    return rows.select("k", F.col("h").alias(end), *[x.alias(c) for c, x in tallied.items()],
                       *[F.col(c).alias(f"{c}{end}") for c in others])


def _plausible(similarity: float) -> Column:
    """Sizes and tallies of the ends a and b leave the Jaccard possible.

    Where a has i and b has j < i shingles in a bin, at least i - j of a are not shared; as many of b are not
    shared then as of a, and those that b has more in all. Four bins are compared at once, in every other byte
    of a long; with a comparison a bin, the method that joins the rows is too long for the JIT compiler.
    """
    def bins(end: str, i: int) -> Column:
        return F.shiftrightunsigned(F.col(f"{end}{i // 2}"), i % 2 * 8).bitwiseAND(F.lit(EVEN))

    def more(i: int) -> Column:
        less = bins("a", i).bitwiseOR(F.lit(BORROW)) - bins("b", i)
        kept = less.bitwiseAND(F.lit(BORROW))  # a one where nothing was borrowed
        return less.bitwiseAND(kept - F.shiftrightunsigned(kept, 8))

    every = [more(i) for i in range(2 * TALLIES)]
    alone = sum(every[1:], every[0]) % F.lit(0xFFFF)  # the sum of its four parts
    return _may_link(F.col("na"), F.col("nb"), similarity) & (
        2 * alone - F.col("na") + F.col("nb") <= F.lit((1 - similarity) / (1 + similarity)) * (F.col("na") + F.col("nb")) + F.lit(1e-6))


def _first_pairs(tallied: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that may link: all pairs of a bucket of at most ``SMALL`` lines, and every member of a larger
    one with each of its pivots; linear in the members."""
    few, many = tallied.where(F.col("n") <= SMALL), tallied.where(F.col("n") > SMALL)
    full = _side(few, "a").join(_side(few, "b"), "k").where((F.col("a") < F.col("b")) & _plausible(similarity))
    line = F.struct("h", *TALLIED)
    picks = [F.min_by(line, F.xxhash64("h", F.lit(i))) for i in range(PIVOTS)]
    pivots = many.groupBy("k").agg(F.array_distinct(F.array(*picks)).alias("p")).select("k", F.explode("p").alias("p")).select("k", "p.*")
    spokes = _side(many, "a").join(_side(pivots, "b"), "k").where((F.col("a") != F.col("b")) & _plausible(similarity))
    return full.select("a", "b").unionByName(spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _open_lines(tallied: DataFrame, component: DataFrame) -> DataFrame:
    """Rows (with component c) of the buckets of more than ``SMALL`` lines that hold several components."""
    named = component.select(F.col("node").alias("h"), "component")
    member = tallied.where(F.col("n") > SMALL).join(named, "h", "left").withColumn("c", F.coalesce("component", "h")).drop("component")
    several = member.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    return member.join(several.select("k"), "k", "left_semi")


def _bucket_pairs(opened: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of different components that may link, in open buckets of at most ``BLOCK`` lines."""
    some = opened.where(F.col("n") <= BLOCK)
    return _side(some, "a", "c").join(_side(some, "b", "c"), "k").where(
        (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _plausible(similarity)).select("a", "b").distinct()


def _common_shingles(lines: DataFrame, sets: DataFrame) -> DataFrame:
    """One row, ``often``: the shingles that several of about ``SAMPLE`` lines hold, rarer ones first.

    They only order shingles: another sample gives the same links, by more or fewer meetings.
    """
    share = -(-lines.count() // SAMPLE)
    some = lines.where(F.pmod(F.xxhash64("h", F.lit(share)), F.lit(max(share, 1))) == 0).join(sets, "h")
    counts = some.select(F.explode("s").alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    most = counts.orderBy(F.desc("n"), "x").limit(4 * SAMPLE)
    return most.agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "x"))), lambda p: p["x"]).alias("often"))


def _meeting_pairs(opened: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of open lines that meet on a rare shingle and that sizes, tallies and places leave possible.

    A line's shingles are put in one order for all lines, common ones last, so that a passage they all
    share brings none together; only those of its prefix become rows. At the first shared shingle no
    more than the shorter rest can be shared beyond it.
    """
    reach = (F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - F.lit(1e-6)) + 1).cast("int")
    common = handover(_common_shingles(opened.select("h"), sets), "line-common")
    ordered = opened.join(sets, "h").crossJoin(F.broadcast(common)).select(
        "h", "c", *TALLIED, F.sort_array("s").alias("s"), "often").select(
        "h", "c", *TALLIED, F.slice(F.concat(F.array_except("s", "often"), F.array_intersect("often", "s")), F.lit(1), reach).alias("p"))
    prefix = handover(ordered.select("h", "c", *TALLIED, F.posexplode("p").alias("at", "k")), "line-prefixes")
    meet = prefix.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("salts"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    asked = prefix.join(meet.where("lo <> hi").select("k", "salts"), "k").withColumn("rest", F.col("size") - F.col("at"))
    left = _side(asked.withColumn("salt", F.pmod(F.xxhash64("h", "k"), F.col("salts").cast("bigint")).cast("int")), "a", "c", "rest", "salt")
    right = _side(asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))), "b", "c", "rest", "salt")
    needed = F.lit(similarity / (1 + similarity)) * (F.col("na") + F.col("nb")) - F.lit(1e-6)
    pairs = left.withColumnRenamed("salta", "salt").join(right.withColumnRenamed("saltb", "salt"), ["k", "salt"]).where(
        (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (F.least("resta", "restb") >= needed) & _plausible(similarity))
    out = handover(pairs.select("a", "b").distinct(), "line-pairs")
    for done in (common, prefix):
        release(sets.sparkSession, done)
    return out


def _links(pairs: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The written ``pairs`` (a, b) whose sets have the Jaccard; bitmaps go before the sets."""
    spark = pairs.sparkSession
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct())
    marks = _bitmaps(sets).withColumn("k", F.lit(0))
    ends = pairs.join(_end(marks, "a").drop("k"), "a").join(_end(marks, "b").drop("k"), "b")
    out = handover(_verified(ends.where(_possible(similarity)).select("a", "b"), sets, similarity), "line-links")
    release(spark, sets)
    return out


def line_components(buckets: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, component) of the lines linked by a verified similarity: buckets (k, h), sets (h, s)."""
    described = _binned(sets.select("h", F.sort_array("s").alias("s"))).select("h", F.size("s").alias("size"), *_tallies(F.col("below")))
    counted = buckets.select("k", "h").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")).cast("int"))
    tallied = handover(_tallied(counted, described), "line-tallied")
    out = _components(tallied, lambda lines: handover(lines.join(sets, "h"), "line-shingles"), similarity)
    release(sets.sparkSession, tallied)
    return out


def _components(tallied: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """(node, component) of the lines linked by a verified similarity.

    Pairs in small buckets and pivots of larger ones come first and settle groups of near copies; lines
    of different components that are left in a common bucket are then compared in full. ``sets_of``
    writes (h, s) of the lines (h) asked for.
    """
    spark = tallied.sparkSession
    pairs = handover(_first_pairs(tallied, similarity), "line-pairs")
    found = _links(pairs, sets_of, similarity)
    component = connected_components(found)
    opened = handover(_open_lines(tallied, component), "line-open")
    release(spark, pairs)
    if not opened.isEmpty():
        pairs = _bucket_pairs(opened, similarity)
        wide = opened.where(F.col("n") > BLOCK).select("h", "c", *TALLIED).distinct()
        if not wide.isEmpty():
            sets = sets_of(wide.select("h"))
            met = _meeting_pairs(wide, sets, similarity)
            release(spark, sets)
            pairs = pairs.unionByName(met).distinct()
        pairs = handover(pairs, "line-pairs")
        last = _links(pairs, sets_of, similarity)
        release(spark, pairs)
        if not last.isEmpty():
            release(spark, component)
            component = connected_components(found.unionByName(last))
        release(spark, last)
    for done in (found, opened):
        release(spark, done)
    return component


def kept_lines(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per numbered row (id, text, row), the sorted numbers of the visible lines that stay: row, stay."""
    spark = rows.sparkSession
    every = handover(distinct_lines(rows), "lines")
    lines = handover(every.select("h", "place"), "line-places")

    def sets_of(asked: DataFrame) -> DataFrame:
        asked = handover(asked, "lines-asked")
        wanted = handover(_likely(lines, asked, "h").join(asked, "h", "left_semi").groupBy("h").agg(F.min("place").alias("place")), "lines-wanted")
        sets = handover(_shingle_sets(rows, wanted), "line-shingles")
        for done in (asked, wanted):
            release(spark, done)
        return sets

    buckets = handover(_shared_buckets(every), "line-buckets")
    tallied = handover(_tallied(buckets, every), "line-tallied")
    for done in (every, buckets):  # most of it are bucket keys
        release(spark, done)
    component = _components(tallied, sets_of, similarity)
    release(spark, tallied)
    linked = component.select(F.col("node").alias("h"), "component")
    root = _likely(lines, linked, "h").join(linked, "h", "left")
    alone = _likely(lines, linked, "h", how="left_anti").select("place").unionByName(root.where(F.col("component").isNull()).select("place"))
    first = root.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("place").alias("place")).select("place")
    stay = alone.unionByName(first).groupBy(F.col("place.row").alias("row")).agg(F.array_sort(F.collect_set("place.no")).alias("stay"))
    out = handover(stay, "lines-kept")
    for done in (lines, component):
        release(spark, done)
    return out


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with only the lines that stay in its texts, plus n_lines and n_removed."""
    given = without(df, {"n_lines", "n_removed"} - {text_col.lower(), id_col.lower()})
    # The other columns travel in one struct, so none can clash with a name used here.
    others = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(given.columns) if c != text_col])
    visible = F.size(F.filter(F.split(F.col(text_col), "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)) != ""))
    rows = handover(given.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), others.alias("given"),
                                 F.monotonically_increasing_id().alias("row"), F.coalesce(visible, F.lit(0)).alias("visible")), "line-rows")
    stay = kept_lines(rows.select("id", "text", "row"), similarity)
    less = F.coalesce(F.size("stay"), F.lit(0)) < F.col("visible")
    cut = handover(rows.select("row", "visible").join(stay, "row", "left").where(less).select("row", "stay"), "lines-cut")

    def given_columns(text: Column) -> list[Column]:
        return [text.alias(c) if c == text_col else F.col(f"given.c{i}").alias(c) for i, c in enumerate(given.columns)]

    n = F.when(F.col("text").isNull(), 0).otherwise(F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)))
    # Texts that lose no line are not shuffled, but for a few.
    whole = _likely(rows, cut, "row", how="left_anti").select(
        *given_columns(F.col("text")), n.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    joined = _likely(rows, cut, "row").join(cut.withColumn("cut", F.lit(True)), "row", "left").withColumn("lines", F.split("text", "\n", -1))
    blank = F.filter(F.transform("lines", lambda x, i: F.when(F.btrim(x, F.lit(BLANK)) == "", i)), lambda i: i.isNotNull())
    numbers = F.array_sort(F.array_union(F.coalesce("stay", F.array().cast("array<int>")), blank))
    joined = joined.withColumn("n", n).withColumn("at", F.when(F.col("cut"), numbers))
    removed = F.when(F.col("cut"), F.col("n") - F.size("at")).otherwise(0)
    text = F.when(F.col("cut"), F.array_join(F.transform("at", lambda i: F.get("lines", i)), "\n")).otherwise(F.col("text"))
    return whole.unionByName(joined.select(*given_columns(text), F.col("n").cast("long").alias("n_lines"), removed.cast("long").alias("n_removed")))
