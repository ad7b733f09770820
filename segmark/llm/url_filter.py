"""URL filter lists (native): host-suffix and path-prefix expressions joined on short digests.

Each distinct (host, path) expands into its host suffixes at label boundaries times its
path prefixes at ``/`` boundaries. Every expression is digested; an equi-join on the first
four digest bytes finds candidate rules, the full digest and the rule's path confirm them,
and the longest confirmed rule decides. Only built-in column functions are used.

Defined results: null url, or one without ``://``: empty host and path, no rule, default
verdict. A rule with a null or empty host never fits; a null rule path counts as empty. Equal
rules with different verdicts: block wins. Repeated and null rows of the input stay as they
are. Columns of the input named like a result column are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT_HEX = 8  # four digest bytes
RESULT = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _keyed_rules(rules: DataFrame) -> DataFrame:
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    folder = F.regexp_extract(path, r"^(.*/)?", 1)  # up to the last slash; the rest is confirmed by text
    return (
        rules.where(F.col("host") != "")
        .select(
            host.alias("rule_host"),
            path.alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
            F.sha2(F.concat(host, folder), 256).alias("rule_digest"),
            F.size(F.split(host, r"\.")).alias("labels"),
            F.size(F.split(folder, "/")).alias("folders"),
        )
        .groupBy("rule_host", "rule_path", "rule_digest", "labels", "folders")
        .agg(F.when(F.max(F.col("rule_verdict") == "block"), "block").otherwise("allow").alias("rule_verdict"))
    )


def _expressions(max_labels: Column, max_folders: Column) -> Column:
    """All host-suffix + path-prefix strings no deeper than the deepest rule."""
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n, max_labels)),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."),
    )
    deep = F.least(F.size(parts), max_folders)
    prefixes = F.transform(
        F.sequence(F.lit(1), deep),
        lambda k: F.when(k > 1, F.concat(F.array_join(F.slice(parts, F.lit(1), k - 1), "/"), F.lit("/"))).otherwise(""),
    )
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule per distinct (host, path): columns host, path, rule, rule_verdict.

    The rule side carries no broadcast hint: Spark broadcasts it below its measured
    threshold and otherwise shuffles both sides by the short digest.
    """
    keyed = _keyed_rules(rules)
    depth = keyed.agg(
        F.coalesce(F.max("labels"), F.lit(0)).alias("max_labels"),
        F.coalesce(F.max("folders"), F.lit(0)).alias("max_folders"),
    )
    max_labels, max_folders = depth.first()
    if not max_labels:
        return urls.limit(0).select("host", "path", F.lit(None).cast("string").alias("rule"),
                                    F.lit(None).cast("string").alias("rule_verdict"))
    keys = urls.where(F.col("host") != "").select("host", "path").distinct()
    asked = keys.select(
        "host", "path", F.explode(_expressions(F.lit(max_labels), F.lit(max_folders))).alias("expression")
    ).select("host", "path", F.sha2("expression", 256).alias("digest"))
    short = lambda c: F.substring(c, 1, SHORT_HEX)
    found = asked.join(keyed, short(asked["digest"]) == short(keyed["rule_digest"])).where(
        (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    )
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), rule.alias("rule"),
                          F.col("rule_verdict")))
    return found.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict")
    )


def filter_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` plus host, path, rule and verdict of its url column.

    ``rules``: columns host, path, verdict (allow or block). ``default`` is the verdict where
    no rule fits. Matching runs on distinct (host, path) pairs, which are pre-aggregated
    before the shuffle; the join back to the rows is an outer equi-join that Spark can
    split when one url holds a large share of them.
    """
    host, path = host_and_path(F.col(url_col))
    rows = without_result(df, url_col).withColumns({"host": host, "path": path})
    best = match_rules(rows, rules)
    joined = rows.join(best, ["host", "path"], "left")
    kept = [c for c in rows.columns if c not in ("host", "path")]
    return joined.select(*[F.col(f"`{c}`") for c in kept], "host", "path", "rule",
                         F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))


def without_result(df: DataFrame, url_col: str) -> DataFrame:
    taken = {*RESULT, "rule_verdict"} - {url_col.lower()}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
