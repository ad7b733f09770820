"""Static state -> macro-region dimension."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# ---- fixed values (part of the result contract) -------------------------------------
# state_code, region, region_idx as seeded, is_capital_state -- in seed order.
STATE_REGION_ROWS = [
    ("AC", "Norte", 0, 0),
    ("AP", "Norte", 0, 0),
    ("AM", "Norte", 0, 0),
    ("PA", "Norte", 0, 0),
    ("RO", "Norte", 0, 0),
    ("RR", "Norte", 0, 0),
    ("TO", "Norte", 0, 0),
    ("AL", "Nordeste", 1, 0),
    ("BA", "Nordeste", 1, 0),
    ("CE", "Nordeste", 1, 0),
    ("MA", "Nordeste", 1, 0),
    ("PB", "Nordeste", 1, 0),
    ("PE", "Nordeste", 1, 0),
    ("PI", "Nordeste", 1, 0),
    ("RN", "Nordeste", 1, 0),
    ("SE", "Nordeste", 1, 0),
    ("DF", "Centro-Oeste", 2, 1),
    ("GO", "Centro-Oeste", 2, 0),
    ("MT", "Centro-Oeste", 2, 0),
    ("MS", "Centro-Oeste", 2, 0),
    ("ES", "Sudeste", 3, 0),
    ("MG", "Sudeste", 3, 0),
    ("RJ", "Sudeste", 3, 1),
    ("SP", "Sudeste", 3, 1),
    ("PR", "Sul", 4, 0),
    ("RS", "Sul", 4, 0),
    ("SC", "Sul", 4, 0),
]
# ---- end of fixed values ----------------------------------------------------------

# The model feature ``region_idx`` numbers regions by name in alphabetical order;
# the seeded index is kept alongside as ``region_idx_seed``.
REGIONS = sorted({r for _, r, _, _ in STATE_REGION_ROWS})
REGION_INDEX = {r: i for i, r in enumerate(REGIONS)}

STATE_DIM_SCHEMA = StructType(
    [
        StructField("state_code", StringType(), False),
        StructField("region", StringType(), False),
        StructField("region_idx", IntegerType(), False),
        StructField("region_idx_seed", IntegerType(), False),
        StructField("is_capital_state", IntegerType(), False),
    ]
)


def state_dim(spark: SparkSession) -> DataFrame:
    """27-row dimension. Its size is fixed by this module, so broadcasting it is safe."""
    rows = [(s, r, REGION_INDEX[r], seed_idx, cap) for s, r, seed_idx, cap in STATE_REGION_ROWS]
    return F.broadcast(spark.createDataFrame(rows, STATE_DIM_SCHEMA))


def region_of(state: Column) -> Column:
    """Map-literal lookup state -> region (J10); NULL for unknown or NULL states."""
    pairs = [x for s, r, _, _ in STATE_REGION_ROWS for x in (F.lit(s), F.lit(r))]
    return F.create_map(*pairs)[state]


def region_index_of(region: Column) -> Column:
    pairs = [x for r, i in REGION_INDEX.items() for x in (F.lit(r), F.lit(i))]
    return F.create_map(*pairs)[region]
