"""Person-level features from staged orders.

Plan of ``customer_features`` (one pass over the orders, no Expand, no per-person collections):

1. ``place_counts``: group the orders by (person, state, city) with partial aggregation, so a
   hot person or state is collapsed map-side. This is the only shuffle of order rows; both
   branches below read the same exchange.
2. ``person_level``: its rows, dealt by person once, give everything that has a person as its
   grain. A window marks each city's first row, so distinct cities become a sum; then two
   aggregates, by (person, state) and by person, run without another shuffle. The primary
   state is ``min(struct(-cnt, is_null, state))``: most orders first, a known state before an
   unknown one, then A-Z.
3. ``state_info``: orders per state and their share, joined with the 27-row region dimension.
   The person rows look it up in a single join whose small side is one row per distinct state
   (AQE broadcasts it after measuring it, else it splits the skewed state).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmark.functions.scalar import UNKNOWN_INT, flag, or_default
from segmark.sources.dims import region_index_of, region_of, state_dim

P = "customer_unique_id"
S = "customer_state"

FEATURE_COLUMNS = [
    "customer_unique_id",
    "primary_customer_id",
    "num_orders",
    "is_repeat_customer",
    "num_distinct_states",
    "num_distinct_cities",
    "zip_macro_region",
    "primary_state",
    "primary_region",
    "region_idx",
    "state_market_share",
]


# ---- order-level aggregates ------------------------------------------------------------
def order_total(stg: DataFrame) -> DataFrame:
    """Global order count as a one-row frame (A1)."""
    return stg.agg(F.count(F.lit(1)).alias("total_orders"))


def state_orders(stg: DataFrame) -> DataFrame:
    """Orders per state, NULL state kept as its own group (A2)."""
    return stg.groupBy(S).agg(F.count(F.lit(1)).alias("state_orders"))


def share_of_total(per_state: DataFrame, count_col: str = "state_orders") -> DataFrame:
    """state count / total count (A3); the total is a scalar subquery over the same counts.

    Nothing bounds the number of distinct raw state texts, so the counts are not brought
    into one partition: each task needs the total only.
    """
    total = per_state.agg(F.sum(count_col)).scalar()
    return per_state.withColumn("state_market_share", F.col(count_col) / total)


def state_share(stg: DataFrame) -> DataFrame:
    return share_of_total(state_orders(stg))


def state_share_sql(stg: DataFrame) -> DataFrame:
    """W3 as SQL text: an aggregate over an aggregate in one SELECT."""
    return stg.sparkSession.sql(
        """
        select customer_state,
               count(*) as state_orders,
               count(*) / sum(count(*)) over () as state_market_share
        from {stg}
        group by customer_state
        """,
        stg=stg,
    )


# ---- person x state --------------------------------------------------------------------
def person_state_counts(stg: DataFrame) -> DataFrame:
    """Orders per (person, state) plus the per-group min id and max zip digit (A4)."""
    return stg.groupBy(P, S).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("customer_id").alias("min_customer_id"),
        F.max("zip_macro_region").alias("max_zip_macro_region"),
    )


def _primary_order():
    # Tie-break: more orders first, then a known state before NULL, then A-Z.
    return [F.desc("cnt"), F.asc_nulls_last(S)]


def primary_state_window(stg: DataFrame) -> DataFrame:
    """Top-1 state per person with ``row_number`` (W1 + P5); becomes a WindowGroupLimit."""
    w = Window.partitionBy(P).orderBy(*_primary_order())
    return (
        person_state_counts(stg)
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == 1)
        .select(P, F.col(S).alias("primary_state"))
    )


def primary_state_sql(stg: DataFrame) -> DataFrame:
    """W2 as SQL text: a ranking window over the (person, state) counts, filtered by QUALIFY-like
    use of a lateral alias."""
    return stg.sparkSession.sql(
        """
        with counts as (select customer_unique_id as person, customer_state as state, count(*) as orders
                        from {orders} group by all),
             placed as (select person, state,
                               rank() over (partition by person order by orders desc, state is null, state) as place
                        from counts)
        select person as customer_unique_id, state as primary_state from placed where place = 1
        """,
        orders=stg,
    )


def _top_state():
    return F.min(
        F.struct(
            (-F.col("cnt")).alias("neg_cnt"),
            F.col(S).isNull().alias("unknown"),
            F.col(S).alias("state"),
        )
    )


def primary_state_struct(stg: DataFrame) -> DataFrame:
    """O2: the same top-1 as an ordinary aggregate -- no sort of the group, no window."""
    return (
        person_state_counts(stg)
        .groupBy(P)
        .agg(_top_state().alias("top"))
        .select(P, F.col("top.state").alias("primary_state"))
    )


# ---- person rollup ---------------------------------------------------------------------
CITY = "customer_city"


def place_counts(stg: DataFrame) -> DataFrame:
    """Orders per (person, state, city) with the group's least id and largest zip digit."""
    return stg.groupBy(P, S, CITY).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min("customer_id").alias("min_customer_id"),
        F.max("zip_macro_region").alias("max_zip_macro_region"),
    )


def person_level(places: DataFrame) -> DataFrame:
    """One row per person from ``place_counts``: order count, least id, distinct states and
    cities, largest zip digit and ``top`` (the primary state).

    All steps after the first have the person in their key and share one exchange.
    """
    first_of_city = F.row_number().over(Window.partitionBy(P, CITY).orderBy(F.asc_nulls_last(S)))
    marked = places.repartition(P).withColumn("new_city", F.when((first_of_city == 1) & F.col(CITY).isNotNull(), 1).otherwise(0))
    by_state = marked.groupBy(P, S).agg(
        F.sum("cnt").alias("cnt"),
        F.min("min_customer_id").alias("min_customer_id"),
        F.max("max_zip_macro_region").alias("max_zip_macro_region"),
        F.sum("new_city").alias("cities"),
    )
    return by_state.groupBy(P).agg(
        F.sum("cnt").alias("num_orders"),
        F.min("min_customer_id").alias("primary_customer_id"),
        F.count(S).alias("num_distinct_states"),
        F.sum("cities").alias("num_distinct_cities"),
        F.max("max_zip_macro_region").alias("zip_macro_region"),
        _top_state().alias("top"),
    )


def person_rollup(stg: DataFrame) -> DataFrame:
    """A5: count, representative id (min, deterministic), distinct states and cities (NULLs
    ignored), max zip digit."""
    return person_level(place_counts(stg)).drop("top")


def state_info(places: DataFrame) -> DataFrame:
    """One row per observed state: share of all orders plus region (from the dimension).

    Unknown states keep their share; their region is NULL. The NULL state is a row too.
    """
    # True for every staged order (ids are never NULL). Naming all aggregates here keeps column
    # pruning from making this branch's exchange differ from person_level's: the plan then
    # reads and groups the orders once and reuses that exchange.
    whole = places.where(F.col("min_customer_id").isNotNull() & (F.coalesce("max_zip_macro_region", F.lit(UNKNOWN_INT)) >= UNKNOWN_INT))
    return described_states(whole.groupBy(S).agg(F.sum("cnt").alias("state_orders")))


def described_states(per_state: DataFrame) -> DataFrame:
    """Share and region of each state, from its orders (customer_state, state_orders)."""
    dim = state_dim(per_state.sparkSession)
    return share_of_total(per_state).join(dim, F.col(S) == dim.state_code, "left").select(
        F.col(S).alias("ss_state"),
        "state_orders",
        "state_market_share",
        F.col("region").alias("ss_region"),
        F.col("region_idx").alias("ss_region_idx"),
    )


def customer_features(stg: DataFrame) -> DataFrame:
    """Eleven person-level features, one row per person (see module docstring)."""
    places = place_counts(stg)
    return feature_rows(person_level(places), state_info(places))


def feature_rows(persons: DataFrame, states: DataFrame) -> DataFrame:
    """``person_level`` rows with the share and region of their primary state: the feature columns."""
    # Null-safe, or the inferred "state is not null" filter would change the state branch's
    # scan and undo the shared exchange; the NULL state's share is left out below instead.
    out = persons.join(states, F.col("top.state").eqNullSafe(F.col("ss_state")), "left")
    share = F.when(F.col("top.state").isNotNull(), F.col("state_market_share"))
    return out.select(
        P,
        "primary_customer_id",
        "num_orders",
        flag(F.col("num_orders") > 1).alias("is_repeat_customer"),
        "num_distinct_states",
        "num_distinct_cities",
        or_default("zip_macro_region", UNKNOWN_INT).alias("zip_macro_region"),
        F.col("top.state").alias("primary_state"),
        F.col("ss_region").alias("primary_region"),
        or_default("ss_region_idx", UNKNOWN_INT).alias("region_idx"),
        F.coalesce(share, F.lit(0.0)).alias("state_market_share"),
    )


# ---- dimension lookups -----------------------------------------------------------------
def region_lookup_join(stg: DataFrame) -> DataFrame:
    """State -> region with a broadcast left join on the static dimension."""
    dim = state_dim(stg.sparkSession)
    return stg.join(dim, F.col(S) == dim.state_code, "left").select(
        "customer_id", S, F.col("region").alias("region"), F.col("region_idx").alias("region_idx")
    )


def region_lookup_map(stg: DataFrame) -> DataFrame:
    """The same lookup as a map literal inside the projection (no join at all)."""
    region = region_of(F.col(S))
    return stg.select("customer_id", S, region.alias("region"), region_index_of(region).alias("region_idx"))
