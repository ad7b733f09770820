"""End-to-end stages (L1-L5, M10, M13). Each stage runs alone over one SparkSession and
hands over through written tables, so a lost executor or a failed stage never needs
more than that stage to be rerun."""
from __future__ import annotations

import datetime as dt
import hashlib
import logging
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from segmark.operators import marts, ml
from segmark.operators.features import customer_features
from segmark.operators.quality import reconcile_load
from segmark.operators.staging import stage_orders
from segmark.params import Settings
from segmark.session import scratch_path
from segmark.sinks import writers
from segmark.sources.raw import data_lines, land_raw_csv, read_raw_csv, with_loaded_at
from segmark.sources.tables import empty_typed, read_dataset

log = logging.getLogger("segmark.stages")


PERSON = "customer_unique_id"


def _write_person_table(df: DataFrame, settings: Settings, kind: str, path: str) -> None:
    """Person-level hand-over table: a path (default) or, in catalog mode, a catalog
    table at the same path bucketed by person."""
    if settings.table_prefix:
        writers.save_as_table(
            df, f"{settings.table_prefix}_{kind}", path=path, fmt=settings.output_format,
            bucket_by=(settings.person_buckets, PERSON),
        )
    else:
        writers.write_table(df, path, fmt=settings.output_format)


def _read_person_table(spark: SparkSession, settings: Settings, kind: str, path: str) -> DataFrame:
    if settings.table_prefix:
        return spark.table(f"{settings.table_prefix}_{kind}")
    return read_dataset(spark, path, settings.output_format)


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count collected while the write runs (A9): no second evaluation of the plan."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _read_raw(spark: SparkSession, settings: Settings) -> DataFrame:
    """The raw orders; with a quarantine path, parsed once into it and reconciled with the files' lines."""
    path, out = settings.paths.raw_orders, settings.paths.quarantine
    if out is None:
        return read_raw_csv(spark, path)
    landed = land_raw_csv(spark, path, out)
    counts = reconcile_load(data_lines(spark, path), landed.kept, landed.quarantined).first()
    if not counts["reconciled"]:
        raise RuntimeError(f"lines read, kept and quarantined do not add up: {counts.asDict()}")
    log.info("%d raw lines: %d kept, %d quarantined in %s", counts["n_read"], counts["n_kept"], counts["n_quarantined"], out)
    return landed.kept


def build_features(
    spark: SparkSession, settings: Settings, raw: DataFrame | None = None, loaded_at: dt.datetime | None = None
) -> int:
    """L1: raw orders -> staged orders (bronze) -> person features (silver).

    Staged orders are written once in columnar form with their load time (S3; ``loaded_at``
    fixes it for reproducible runs); the features read only the columns they need from that
    table instead of re-parsing the raw input.
    """
    if raw is None:
        raw = _read_raw(spark, settings)
    fmt = settings.output_format
    writers.write_table(with_loaded_at(stage_orders(raw), loaded_at), settings.paths.bronze, fmt=fmt)
    feats, obs = _counted(customer_features(read_dataset(spark, settings.paths.bronze, fmt)), "features")
    _write_person_table(feats, settings, "features", settings.paths.silver_features)
    n = int(obs.get["rows"])
    log.info("features written to %s (%d rows)", settings.paths.silver_features, n)
    return n


def metrics_frame(spark: SparkSession, result: ml.TrainResult, model_version: str, run_id: str | None = None) -> DataFrame:
    """Run parameters and metrics as rows (M10): (run_id, model_version, key, value)."""
    rid = run_id or uuid.uuid4().hex
    rows = [(rid, model_version, k, float(v)) for k, v in result.metrics]
    return spark.createDataFrame(rows, "run_id string, model_version string, key string, value double")


def train_stage(spark: SparkSession, settings: Settings) -> ml.TrainResult:
    """L2: silver features -> k sweep / fixed k -> saved model + appended run metrics."""
    feats = _read_person_table(spark, settings, "features", settings.paths.silver_features)
    result = ml.train(feats, settings.model)
    writers.save_model(result.model, settings.paths.model_dir)
    metrics_frame(spark, result, settings.model_version).write.mode("append").parquet(settings.paths.metrics)
    log.info("model k=%d silhouette=%.4f saved to %s", result.k, result.silhouette, settings.paths.model_dir)
    return result


def score_stage(
    spark: SparkSession, settings: Settings, scored_at: dt.datetime | None = None, overwrite: str = "static"
) -> int:
    """L3: silver features + saved model -> gold table partitioned by region.

    ``overwrite='static'`` is a full refresh (regions that disappeared are removed);
    ``'dynamic'`` replaces only the regions present in this run (partial refresh)."""
    feats = _read_person_table(spark, settings, "features", settings.paths.silver_features)
    model = writers.load_model(settings.paths.model_dir)
    gold, obs = _counted(ml.score(model, feats, settings.model_version, scored_at), "gold")
    writers.write_table(
        gold, settings.paths.gold_segments, fmt=settings.output_format, partition_by=["primary_region"], overwrite=overwrite
    )
    n = int(obs.get["rows"])
    log.info("segments written to %s (%d rows)", settings.paths.gold_segments, n)
    return n


#: k of a retraining whose settings name none.
RETRAIN_K = 5


def retrain_stage(spark: SparkSession, settings: Settings, ml_table_path: str, warm: bool = False) -> int:
    """Retrain with the settings' k and overwrite the model assignment table, the stored model
    and append the run's metrics.

    ``warm`` starts from the model stored by the run before: segments keep their ids, and unchanged
    persons settle in one step. Without a stored model that is an error.
    """
    feats = _read_person_table(spark, settings, "features", settings.paths.silver_features)
    start = writers.load_model(settings.paths.model_dir) if warm else None
    params = settings.model if settings.model.k is not None or warm else replace(settings.model, k=RETRAIN_K)
    table, result = ml.retrain_segments(feats, params, start)
    table, obs = _counted(table, "ml_table")
    _write_person_table(table, settings, "ml_segments", ml_table_path)
    writers.save_model(result.model, settings.paths.model_dir)
    metrics_frame(spark, result, settings.model_version).write.mode("append").parquet(settings.paths.metrics)
    return int(obs.get["rows"])


def read_ml_table(spark: SparkSession, settings: Settings, ml_table_path: str) -> DataFrame:
    """The model assignment table written by ``retrain_stage``."""
    return _read_person_table(spark, settings, "ml_segments", ml_table_path)


def build_marts_stage(
    spark: SparkSession,
    settings: Settings,
    out_dir: str,
    ml_table: DataFrame | None = None,
    scored_at: dt.datetime | None = None,
) -> dict[str, str]:
    """Dim, fact and wide mart. Without a model table every person falls back to
    the rule segment. The resolved relation is written once; the three tables are
    column projections of it, each laid out by its cluster keys."""
    feats = _read_person_table(spark, settings, "features", settings.paths.silver_features)
    ml_tab = ml_table if ml_table is not None else empty_typed(spark, marts.ML_SCHEMA)
    resolved_path = scratch_path(spark, "resolved")
    writers.write_table(marts.resolve_segments(feats, ml_tab, settings.model_version, scored_at), resolved_path)
    resolved = read_dataset(spark, resolved_path)
    layout = {
        "dim_customers": (resolved.select(*marts.DIM_COLUMNS), ["primary_region"]),
        "fct_customer_segments": (resolved.select(*marts.FACT_COLUMNS), ["segment_id"]),
        # Read by region, by segment or by both.
        "mart_bi_customer_segments": (marts.mart_from_resolved(resolved), ["primary_region", "segment_id"]),
    }
    paths = {}
    for name, (df, keys) in layout.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        laid = writers.clustered(df, keys) if len(keys) == 1 else writers.interleaved(df, keys)
        writers.write_table(laid, path, fmt=settings.output_format, rebalance=False)
        paths[name] = path
    writers.remove(spark, resolved_path)
    return paths


# ---- resumable builds -------------------------------------------------------------------
STAGES = ("features", "train", "score")


def _files(spark: SparkSession, path: str) -> list[str]:
    """Name, length and time of every file below ``path``; empty if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        f = found.next()
        out.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return sorted(out)


def _fingerprint(spark: SparkSession, inputs: list[str], *given: object) -> str:
    """Digest of the files below ``inputs`` and of the parameters that a stage works on."""
    parts = [line for path in inputs for line in _files(spark, path)] + [repr(g) for g in given]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def finished_stages(spark: SparkSession, settings: Settings) -> dict[str, dict]:
    """Per stage its latest manifest row: inputs, outputs (fingerprints), rows."""
    if settings.paths.manifest is None or not _files(spark, settings.paths.manifest):
        return {}
    rows = read_dataset(spark, settings.paths.manifest)
    latest = rows.groupBy("stage").agg(F.max(F.struct("at", "inputs", "outputs", "n_rows", "k", "silhouette")).alias("r"))
    return {r["stage"]: r["r"].asDict() for r in latest.collect()}  # one row a stage


def build_all(spark: SparkSession, settings: Settings, raw: DataFrame | None = None, resume: bool = False, until: str = "score") -> dict[str, object]:
    """L4: features -> train -> score, each stage also runnable on its own.

    With ``resume`` a stage is skipped if the manifest says that it ended on the same input files and
    parameters and its output files are still those it wrote; what ran is returned under ``ran``.
    ``raw`` given as a frame has no fingerprint, so it cannot be resumed. ``until`` names the last stage.
    """
    if until not in STAGES:
        raise ValueError(f"unknown stage {until!r}")
    if resume and (raw is not None or settings.paths.manifest is None):
        raise ValueError("a resumable build reads the raw path and needs a manifest path")
    p, out = settings.paths, {"ran": []}
    plan = {
        "features": ([p.raw_orders], p.silver_features, (settings.output_format, p.quarantine, settings.table_prefix, settings.person_buckets)),
        "train": ([p.silver_features], p.model_dir, (settings.model, settings.model_version)),
        "score": ([p.silver_features, p.model_dir], p.gold_segments, (settings.model_version, settings.output_format)),
    }
    for stage in STAGES[: STAGES.index(until) + 1]:
        inputs, written, given = plan[stage]
        mark = _fingerprint(spark, inputs, *given) if resume else ""
        done = finished_stages(spark, settings).get(stage) if resume else None
        if done and done["inputs"] == mark and done["outputs"] == _fingerprint(spark, [written]):
            n_rows, k, silhouette = done["n_rows"], done["k"], done["silhouette"]
        else:
            n_rows, k, silhouette = 0, None, None
            if stage == "features":
                n_rows = build_features(spark, settings, raw)
            elif stage == "train":
                result = train_stage(spark, settings)
                k, silhouette = result.k, result.silhouette
            else:
                n_rows = score_stage(spark, settings)
            out["ran"].append(stage)
            if resume:
                row = (stage, dt.datetime.now(dt.timezone.utc), mark, _fingerprint(spark, [written]), n_rows, k, silhouette)
                spark.createDataFrame([row], "stage string, at timestamp, inputs string, outputs string, n_rows long, k int, silhouette double").coalesce(
                    1).write.mode("append").parquet(p.manifest)
        if stage == "train":
            out |= {"k": k, "silhouette": silhouette}
        else:
            out["features" if stage == "features" else "gold"] = n_rows
    return out
