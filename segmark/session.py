"""SparkSession construction and the reliable checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime broadcast bound: AQE turns a shuffle join into a broadcast join only when the
# materialised side is below this many bytes (32 MB by default).
BROADCAST_BYTES = 32 * 1024 * 1024


# Target bytes per shuffle partition.
PARTITION_BYTES = 256 * 1024 * 1024
# Shuffled bytes per source byte: the widest shuffle carries partial aggregates of a few
# columns (person, state, city, counts and an id), about a tenth of the raw order rows.
SHUFFLE_RATIO = 0.1
# More reducers than this cost more in map-output bookkeeping than they give in size.
MAX_PARTITIONS = 20_000


def partitions_for(shuffled_bytes: float, per_partition: int = PARTITION_BYTES) -> int:
    """Initial partition count for a shuffle of ``shuffled_bytes``; AQE coalesces small ones."""
    return max(64, min(MAX_PARTITIONS, -(-int(shuffled_bytes) // per_partition)))


def scale_conf(input_bytes: int, shuffle_ratio: float = SHUFFLE_RATIO) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of source data.

    The initial partitions come from the bytes that are shuffled, estimated as a share of the
    input; beyond the limit partitions grow instead, and spill. 100 TB: 20,000 partitions.
    """
    n = partitions_for(input_bytes * shuffle_ratio)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def session_conf(shuffle_partitions: int = 64) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.ui.enabled": "false",
    }


def build_session(
    master: str | None = None,
    app_name: str = "segmark",
    shuffle_partitions: int = 64,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**session_conf(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _conf_get(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - unset static key on some session types
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint()`` and hand-over tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``. Only
    when it is unset *and* Spark runs in local mode (tests, bench) do we create a
    fresh local folder; a cluster without the setting is a configuration error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a driver-side context
        configured = _conf_get(spark, "spark.checkpoint.dir")
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _conf_get(spark, "spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="segmark-ckpt-", dir=os.environ.get("SEGMARK_TMP"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused sub-path of the checkpoint folder for a written hand-over table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
