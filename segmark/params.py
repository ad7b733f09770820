"""Typed job parameters (L6): environment > mapping > code default."""
from __future__ import annotations

import os
from dataclasses import MISSING, dataclass, field, fields, replace
from typing import Any, Mapping

# Feature columns of the segmentation model, in model order (fixed values).
MODEL_FEATURES = (
    "num_orders",
    "is_repeat_customer",
    "num_distinct_states",
    "num_distinct_cities",
    "zip_macro_region",
    "state_market_share",
    "region_idx",
)


# Buckets of person-keyed catalog tables: a layout choice of the tables, not of the session.
PERSON_BUCKETS = 16


@dataclass(frozen=True)
class Paths:
    """Where each stage reads and writes; on a cluster all of them in shared storage."""

    raw_orders: str
    bronze: str
    silver_features: str
    gold_segments: str
    model_dir: str
    metrics: str
    # Parsed raw rows with the malformed lines among them; without it these are dropped uncounted.
    quarantine: str | None = None
    # Which stages a resumable build has finished, and on what.
    manifest: str | None = None

    @staticmethod
    def under(base: str, raw_orders: str, quarantine: bool = False) -> "Paths":
        """The usual layout below one base folder."""
        b = base.rstrip("/")
        return Paths(raw_orders, f"{b}/bronze/orders", f"{b}/silver/customer_features", f"{b}/gold/customer_segments",
                     f"{b}/artifacts/model", f"{b}/artifacts/run_metrics", f"{b}/quarantine/orders" if quarantine else None, f"{b}/artifacts/stages")


@dataclass(frozen=True)
class ModelParams:
    k: int | None = None  # None -> choose k by silhouette sweep; n -> fixed k
    k_search_min: int = 3
    k_search_max: int = 8
    max_iter: int = 50
    seed: int = 42
    features: tuple[str, ...] = MODEL_FEATURES
    # Partitions that the distinct points are dealt into for all passes of a training. They are named
    # here (and in the run metrics), never derived from the session or the data; the result is the
    # same for any number. Raise it with the cluster: one core works on one partition.
    layout_partitions: int = 16


@dataclass(frozen=True)
class SparkParams:
    """Spark settings of a job; ``conf()`` gives them to the session builder."""

    shuffle_partitions: int = 64
    broadcast_bytes: int = 32 * 1024 * 1024
    extra: Mapping[str, str] = field(default_factory=dict)

    def conf(self) -> dict[str, str]:
        return {
            "spark.sql.shuffle.partitions": str(self.shuffle_partitions),
            "spark.sql.autoBroadcastJoinThreshold": str(self.broadcast_bytes),
            "spark.sql.adaptive.autoBroadcastJoinThreshold": str(self.broadcast_bytes),
            **{str(k): str(v) for k, v in self.extra.items()},
        }


@dataclass(frozen=True)
class Settings:
    paths: Paths
    model: ModelParams = field(default_factory=ModelParams)
    spark: SparkParams = field(default_factory=SparkParams)
    model_version: str = "v1.0.0"
    output_format: str = "parquet"
    # Catalog mode: when set, silver features and the model table are also catalog
    # tables named "<prefix>_features" / "<prefix>_ml_segments", bucketed by person into
    # ``person_buckets`` buckets (size it to ~person-table bytes / 256 MB), so the
    # features x model-table join reads both sides co-located.
    table_prefix: str | None = None
    person_buckets: int = PERSON_BUCKETS

    @staticmethod
    def load(data: Mapping[str, Any], env: Mapping[str, str] | None = None) -> "Settings":
        """Build settings from a plain mapping (e.g. parsed job config); env wins.

        Sections: ``paths`` (required), ``model`` and ``spark``; any unknown key is an error.
        """
        env = os.environ if env is None else env
        values = dict(data)
        known = {f.name for f in fields(Settings)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown Settings keys: {sorted(unknown)}")
        values["paths"] = _build(Paths, values.get("paths", {}))
        values["model"] = _build(ModelParams, values.get("model", {}))
        values["spark"] = _build(SparkParams, values.get("spark", {}))
        for name in ("model_version", "output_format"):
            if name.upper() in env:
                values[name] = env[name.upper()]
        return Settings(**values)

    def with_model(self, **kw: Any) -> "Settings":
        return replace(self, model=replace(self.model, **kw))


def _build(cls, values: Mapping[str, Any]):
    names = {f.name for f in fields(cls)}
    unknown = set(values) - names
    if unknown:
        raise ValueError(f"unknown {cls.__name__} keys: {sorted(unknown)}")
    missing = [f.name for f in fields(cls) if f.name not in values and f.default is MISSING and f.default_factory is MISSING]
    if missing:
        raise ValueError(f"missing {cls.__name__} keys: {missing}")
    vals = dict(values)
    if "features" in vals:
        vals["features"] = tuple(vals["features"])
    return cls(**vals)
