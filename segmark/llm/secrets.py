"""Secret scan (native) over a content-addressed ledger of blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds one row
per (blob, rule, rule version) that was scanned, with the spans found. A run scans only
pairs the ledger lacks, each blob once however many paths carry it, appends them, and joins
the findings back to all paths. Only built-in column functions are used.

Spans are code points, end exclusive. Match k of a rule starts after k + 1 gaps and k
matches; gaps come from ``split`` and matches from ``regexp_extract_all``, which walk the
text the same way, and a running sum over the (text-free) match rows places them.

Defined results: a null text is the empty blob (no spans). Repeated rows and null ids keep
their rows. An empty table or empty ledger gives an empty ledger and no findings. Input
columns named like a result column are replaced.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmark.llm.common import handover, without


@dataclass(frozen=True)
class SecretRule:
    """``group``: the capture group that must have ``least`` code points (0: the whole match)."""

    kind: str
    version: str
    pattern: str
    group: int
    least: int
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token"))
_NAMES += "|" + _either_case("api") + "_?" + _either_case("key")

# Order matters: it breaks ties between spans that start together. A run of at least 24
# (access: 20) characters is the same set of maximal runs as "any run, then drop the short
# ones", since no later match can begin inside a run that failed.
RULES: tuple[SecretRule, ...] = (
    SecretRule("assign", "1", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    SecretRule("access", "1", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    SecretRule("hex", "1", r"[0-9a-f]{24,}", 0, 24, True),
    SecretRule("pem", "1", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    SecretRule("forge", "1", r"gh[pousr]_[A-Za-z0-9]{36,255}", 0, 40),
    SecretRule("jwt", "1", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
)
RESULT = ("blob", "n_assign", "n_access", "n_hex", "base_sha256", "base_spans", "spans")
LEDGER = "blob string, rule string, rule_version string, spans array<struct<start: int, end: int>>"


def _lengths(text: Column, rule: SecretRule) -> Column:
    """Gap, match and judged-group lengths of every match of a rule, as an array of structs."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    gaps = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(
        F.transform(matches, F.length).alias("m"),
        F.transform(judged, F.length).alias("j"),
        F.transform(gaps, F.length).alias("gap"),
    )
    return F.when(text.rlike(rule.pattern), F.filter(zipped, lambda z: z["m"].isNotNull()))


def scan_blobs(blobs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, seen): one per rule that ``seen`` lacks."""
    asked = [
        F.struct(
            F.lit(r.kind).alias("rule"),
            F.lit(r.version).alias("rule_version"),
            F.lit(r.least).alias("least"),
            F.array_contains("seen", r.key).alias("known"),
            _lengths(F.col("text"), r).alias("found"),
        )
        for r in rules
    ]
    scanned = blobs.select("blob", F.explode(F.array(*asked)).alias("s")).where(~F.col("s.known")).select(
        "blob", "s.rule", "s.rule_version", "s.least", "s.found")
    # One text-free row per match; a rule without a match keeps one row of nulls.
    matches = scanned.select("blob", "rule", "rule_version", "least", F.posexplode_outer("found").alias("k", "x"))
    before = Window.partitionBy("blob", "rule", "rule_version").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.coalesce(F.sum(F.col("x.gap") + F.col("x.m")).over(before), F.lit(0)) + F.col("x.gap")).cast("int")
    placed = matches.withColumn("start", start).withColumn("end", (F.col("start") + F.col("x.m")).cast("int"))
    span = F.when(F.col("x.j") >= F.col("least"), F.struct("start", "end"))
    return placed.groupBy("blob", "rule", "rule_version").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def addressed(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus ``blob``, the SHA-256 of its text (null: of the empty text)."""
    return without(df, ["blob"]).withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """One row per blob some rule version has not seen: blob, text, seen (rule@version keys).

    Copies collapse in each task before the shuffle, so a text that holds a third of all
    rows sends one row per task.
    """
    blobs = versions.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    if ledger is None:
        return blobs.withColumn("seen", F.array().cast("array<string>"))
    keys = F.concat_ws("@", "rule", "rule_version")
    known = ledger.where(keys.isin([r.key for r in rules])).groupBy("blob").agg(F.collect_set(keys).alias("seen"))
    open_ = versions.select("blob").distinct().join(known, "blob", "left").where(
        F.coalesce(F.size("seen"), F.lit(0)) < len(rules))
    return blobs.join(open_, "blob").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))


def update_ledger(spark: SparkSession, versions: DataFrame, path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it, and return the whole ledger.

    ``versions``: blob and text of every historical version. The appended files commit as
    one job; a failed run leaves the ledger as it was and a rerun scans the same pairs.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
    ledger = spark.read.schema(LEDGER).parquet(path) if there else None
    scan_blobs(unseen_blobs(versions, ledger, rules), rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings(ledger: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Per blob with a span: counts per base rule, base digest text and all spans.

    A pair that two runs started together have both scanned counts once.
    """
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = F.concat_ws("@", "rule", "rule_version").isin([r.key for r in rules])
    hits = ledger.where(current & (F.size("spans") > 0)).dropDuplicates(["blob", "rule", "rule_version"])
    spans = hits.select("blob", "rule", F.explode("spans").alias("s")).groupBy(
        "blob").agg(F.sort_array(F.collect_list(F.struct(
            F.col("s.start").alias("start"), order[F.col("rule")].alias("rank"),
            F.col("rule").alias("kind"), F.col("s.end").alias("end")))).alias("all"))
    base_kinds = [r.kind for r in rules if r.base]
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "blob",
        *[count(k).alias(f"n_{k}") for k in base_kinds],
        text(F.filter("all", lambda s: s["kind"].isin(base_kinds))).alias("base_spans"),
        text(F.col("all")).alias("spans"),
    )


def scan_secrets(df: DataFrame, ledger_path: str, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``df`` plus blob, n_assign, n_access, n_hex, base_sha256 and spans of its text.

    The findings are written before they are joined back, so that the join reads two plain
    shuffles and Spark can split a blob that a large share of the paths carries.
    """
    spark = df.sparkSession
    versions = addressed(without(df, RESULT))
    ledger = update_ledger(spark, versions.select("blob", "text"), ledger_path, rules)
    # The ledger grows with history; only the blobs of this run are looked at.
    own = ledger.where(F.size("spans") > 0).join(versions.select("blob"), "blob", "left_semi")
    found = handover(findings(own, rules), "secret-findings")
    joined = versions.join(found, "blob", "left")
    kept = [F.col(f"`{c}`") for c in versions.columns if c != "blob"]
    return joined.select(
        *kept, "blob",
        *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules if r.base],
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
