"""Raw order rows derived from the driver's TPC-H-like tables.

The operators work on a CSV of orders (one row per order, person id, zip prefix, city,
state). No such file is given, so this relation stands in for it, built from ``orders``, the
order's lowest supplier key in ``lineitem`` and that supplier's nation in ``supplier``. Every
order gives one row. Most persons order once: a customer's orders count as one person's
for every tenth order key only, the others as guests of their own. Some keys are missing and
some zip, city and state values are dirty, so that staging has real work to do.

At scale: one partial aggregate of ``lineitem`` by order key, one shuffle join with
``orders`` on the same key and one join with ``supplier`` (AQE broadcasts it when the
materialised side is under the broadcast bound, else a sort-merge join).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.sources.tables import read_table

# ---- fixed values (adapter definition) --------------------------------------------
# supplier nation key -> raw state text; 'mg ' needs cleaning, 'XX' is unmapped.
NATION_STATE_BANDS = [
    (0, 9, "SP"),
    (10, 12, "RJ"),
    (13, 14, "mg "),
    (15, 15, "RS"),
    (16, 16, "PR"),
    (17, 17, "SC"),
    (18, 18, "BA"),
    (19, 19, "DF"),
    (20, 20, "GO"),
    (21, 21, "PA"),
    (22, 22, "AM"),
    (23, 23, "PE"),
    (24, 24, "XX"),
]
# Order keys divisible by these get a dirty zip ('x' prefix) / a zip that needs trim.
DIRTY_ZIP_EVERY = 97
PADDED_ZIP_EVERY = 11
# Order keys divisible by these get an upper-case city / a city with a trailing space.
UPPER_CITY_EVERY = 5
TRAILING_CITY_EVERY = 7
CITY_COUNT = 40
# Order keys divisible by this belong to the customer's own account; others to a guest.
ACCOUNT_EVERY = 10
# Order keys divisible by these lack their order id / their person id.
NO_ORDER_ID_EVERY = 211
NO_PERSON_EVERY = 199
# ---- end of fixed values -----------------------------------------------------------


def _state_of(nation: Column) -> Column:
    expr = None
    for lo, hi, code in NATION_STATE_BANDS:
        cond = nation.between(lo, hi)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with the five raw string columns (schema ``RAW_SCHEMA``)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first_supplier = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("supp"))
    )
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    joined = orders.join(first_supplier, orders.o_orderkey == first_supplier.l_orderkey, "left").join(
        supplier, F.col("supp") == supplier.s_suppkey, "left"
    )
    key = F.col("o_orderkey")
    supp = F.col("supp")
    # The modulo tests below only choose which rows get dirty values; no row is dropped.
    zip_raw = (
        F.when(key % DIRTY_ZIP_EVERY == 0, F.concat(F.lit("x"), supp.cast("string")))
        .when(key % PADDED_ZIP_EVERY == 0, F.concat(F.lit(" "), (supp * 13).cast("string")))
        .otherwise(F.lpad(((supp * 7919) % 100000).cast("string"), 5, "0"))
    )
    city_base = F.concat(F.lit("city "), (supp % CITY_COUNT).cast("string"))
    city_raw = (
        F.when(key % UPPER_CITY_EVERY == 0, F.upper(city_base))
        .when(key % TRAILING_CITY_EVERY == 0, F.concat(city_base, F.lit(" ")))
        .otherwise(city_base)
    )
    account = F.col("o_custkey").cast("string")
    person = F.when(key % NO_PERSON_EVERY == 0, F.lit(None)).when(key % ACCOUNT_EVERY == 0, account).otherwise(
        F.concat_ws("-", account, key.cast("string")))
    return joined.select(
        F.when(key % NO_ORDER_ID_EVERY != 0, key.cast("string")).alias("customer_id"),
        person.alias("customer_unique_id"),
        zip_raw.alias("customer_zip_code_prefix"),
        city_raw.alias("customer_city"),
        _state_of(F.col("s_nationkey")).alias("customer_state"),
    )
