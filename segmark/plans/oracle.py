"""Independent SQL oracles (DuckDB dialect) for the catalog queries.

Written from the operator semantics, not generated from the DataFrame code. Every
query starts from the same views the driver registers (orders, lineitem, supplier,
events, ...). Shared CTEs are composed below; each entry is ``WITH <ctes> SELECT ...``.
"""
from __future__ import annotations

_RAW = """
loc as (
    select l_orderkey, min(l_suppkey) as supp from lineitem group by l_orderkey
),
raw_orders as (
    select case when o_orderkey % 211 <> 0 then cast(o_orderkey as varchar) end as customer_id,
           case when o_orderkey % 199 = 0 then null
                when o_orderkey % 10 = 0 then cast(o_custkey as varchar)
                else cast(o_custkey as varchar) || '-' || cast(o_orderkey as varchar) end as customer_unique_id,
           case when o_orderkey % 97 = 0 then 'x' || cast(supp as varchar)
                when o_orderkey % 11 = 0 then ' ' || cast(supp * 13 as varchar)
                else lpad(cast((supp * 7919) % 100000 as varchar), 5, '0') end as customer_zip_code_prefix,
           case when o_orderkey % 5 = 0 then upper('city ' || cast(supp % 40 as varchar))
                when o_orderkey % 7 = 0 then 'city ' || cast(supp % 40 as varchar) || ' '
                else 'city ' || cast(supp % 40 as varchar) end as customer_city,
           case when s_nationkey between 0 and 9 then 'SP'
                when s_nationkey between 10 and 12 then 'RJ'
                when s_nationkey between 13 and 14 then 'mg '
                when s_nationkey = 15 then 'RS' when s_nationkey = 16 then 'PR'
                when s_nationkey = 17 then 'SC' when s_nationkey = 18 then 'BA'
                when s_nationkey = 19 then 'DF' when s_nationkey = 20 then 'GO'
                when s_nationkey = 21 then 'PA' when s_nationkey = 22 then 'AM'
                when s_nationkey = 23 then 'PE' when s_nationkey = 24 then 'XX' end as customer_state
    from orders
    left join loc on l_orderkey = o_orderkey
    left join supplier on s_suppkey = supp
)"""

_INITCAP = (
    "array_to_string(list_transform(string_split(lower({x}), ' '), "
    "lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
)

_STG = """
stg as (
    select customer_id,
           customer_unique_id,
           lpad(trim(customer_zip_code_prefix), 5, '0') as zip_code_prefix,
           try_cast(left(trim(customer_zip_code_prefix), 1) as integer) as zip_macro_region,
           {city} as customer_city,
           upper(trim(customer_state)) as customer_state
    from raw_orders
    where customer_id is not null and customer_unique_id is not null
)""".replace("{city}", _INITCAP.format(x="trim(customer_city)"))

_STG_RAW = """
stg as (
    select customer_id,
           customer_unique_id,
           customer_zip_code_prefix as zip_code_prefix,
           try_cast(left(customer_zip_code_prefix, 1) as integer) as zip_macro_region,
           customer_city,
           customer_state
    from raw_orders
    where customer_id is not null and customer_unique_id is not null
)"""

_REGION_MAP = """
region_map as (
    select * from (values
        ('AC', 'Norte', 2, 0, 0), ('AP', 'Norte', 2, 0, 0), ('AM', 'Norte', 2, 0, 0),
        ('PA', 'Norte', 2, 0, 0), ('RO', 'Norte', 2, 0, 0), ('RR', 'Norte', 2, 0, 0),
        ('TO', 'Norte', 2, 0, 0),
        ('AL', 'Nordeste', 1, 1, 0), ('BA', 'Nordeste', 1, 1, 0), ('CE', 'Nordeste', 1, 1, 0),
        ('MA', 'Nordeste', 1, 1, 0), ('PB', 'Nordeste', 1, 1, 0), ('PE', 'Nordeste', 1, 1, 0),
        ('PI', 'Nordeste', 1, 1, 0), ('RN', 'Nordeste', 1, 1, 0), ('SE', 'Nordeste', 1, 1, 0),
        ('DF', 'Centro-Oeste', 0, 2, 1), ('GO', 'Centro-Oeste', 0, 2, 0),
        ('MT', 'Centro-Oeste', 0, 2, 0), ('MS', 'Centro-Oeste', 0, 2, 0),
        ('ES', 'Sudeste', 3, 3, 0), ('MG', 'Sudeste', 3, 3, 0), ('RJ', 'Sudeste', 3, 3, 1),
        ('SP', 'Sudeste', 3, 3, 1),
        ('PR', 'Sul', 4, 4, 0), ('RS', 'Sul', 4, 4, 0), ('SC', 'Sul', 4, 4, 0)
    ) as t(state_code, region, region_idx, region_idx_seed, is_capital_state)
)"""

_FEATURES = """
ps as (
    select customer_unique_id, customer_state,
           count(*) as n,
           min(customer_id) as first_id,
           max(zip_macro_region) as top_zip
    from stg
    group by customer_unique_id, customer_state
),
state_share as (
    select customer_state,
           cast(sum(n) as bigint) as state_orders,
           sum(n) / (select count(*) from stg) as state_market_share
    from ps
    group by customer_state
),
primary_state as (
    select customer_unique_id, customer_state as primary_state
    from ps
    qualify row_number() over (partition by customer_unique_id
                               order by n desc, customer_state asc nulls last) = 1
),
city_counts as (
    select customer_unique_id, count(distinct customer_city) as num_distinct_cities
    from stg
    group by customer_unique_id
),
person_agg as (
    select p.customer_unique_id,
           min(p.first_id) as primary_customer_id,
           cast(sum(p.n) as bigint) as num_orders,
           case when sum(p.n) > 1 then 1 else 0 end as is_repeat_customer,
           count(p.customer_state) as num_distinct_states,
           any_value(c.num_distinct_cities) as num_distinct_cities,
           max(p.top_zip) as zip_macro_region
    from ps p
    join city_counts c on c.customer_unique_id = p.customer_unique_id
    group by p.customer_unique_id
),
features as (
    select a.customer_unique_id,
           a.primary_customer_id,
           a.num_orders,
           a.is_repeat_customer,
           a.num_distinct_states,
           a.num_distinct_cities,
           coalesce(a.zip_macro_region, -1) as zip_macro_region,
           p.primary_state,
           r.region as primary_region,
           coalesce(r.region_idx, -1) as region_idx,
           coalesce(s.state_market_share, 0.0) as state_market_share
    from person_agg a
    left join primary_state p on a.customer_unique_id = p.customer_unique_id
    left join region_map r on p.primary_state = r.state_code
    left join state_share s on p.primary_state = s.customer_state
),
rules as (
    select f.*,
           case when num_orders >= 3 then 'Recurrente alto'
                when is_repeat_customer = 1 then 'Recurrente'
                when num_distinct_states > 1 then 'Itinerante'
                when state_market_share > 0.30 then 'Metropolitano'
                else 'Estándar regional' end as segment_label_rule
    from features f
),
assigned as (
    select r.*,
           case segment_label_rule when 'Recurrente alto' then 0 when 'Recurrente' then 1
                when 'Itinerante' then 2 when 'Metropolitano' then 3 else 4 end as segment_id
    from rules r
),
known_profile as (
    select segment_id,
           case when avg(num_orders) > 1.3 then 'Recurrente'
                when avg(num_distinct_states) > 1.05 then 'Itinerante'
                when avg(state_market_share) > 0.30 then 'Metropolitano'
                else 'Estándar regional' end as segment_label
    from assigned
    where primary_state is not null
    group by segment_id
),
ml_table as (
    select a.customer_unique_id, a.segment_id, k.segment_label
    from assigned a
    left join known_profile k on a.segment_id = k.segment_id
    where a.primary_state is not null
),
resolved as (
    select r.*,
           coalesce(m.segment_id, -1) as segment_id,
           coalesce(m.segment_label, r.segment_label_rule) as segment_label,
           case when m.segment_id is not null then 'kmeans' else 'rule_based' end as segment_source,
           'v1.0.0' as model_version,
           timestamp '2024-02-01 00:00:00' as scored_at
    from rules r
    left join ml_table m on r.customer_unique_id = m.customer_unique_id
),
fallback as (
    select r.*,
           -1 as segment_id,
           r.segment_label_rule as segment_label,
           'rule_based' as segment_source,
           'v1.0.0' as model_version,
           timestamp '2024-02-01 00:00:00' as scored_at
    from rules r
)"""

_SCALED = """
stats as (
    select avg(num_orders) as m1, stddev_samp(num_orders) as s1,
           avg(is_repeat_customer) as m2, stddev_samp(is_repeat_customer) as s2,
           avg(num_distinct_states) as m3, stddev_samp(num_distinct_states) as s3,
           avg(num_distinct_cities) as m4, stddev_samp(num_distinct_cities) as s4,
           avg(zip_macro_region) as m5, stddev_samp(zip_macro_region) as s5,
           avg(state_market_share) as m6, stddev_samp(state_market_share) as s6,
           avg(region_idx) as m7, stddev_samp(region_idx) as s7
    from features
),
scaled as (
    select a.customer_unique_id, a.segment_id,
           case when coalesce(s1, 0) = 0 then 0.0 else (num_orders - m1) / s1 end as x1,
           case when coalesce(s2, 0) = 0 then 0.0 else (is_repeat_customer - m2) / s2 end as x2,
           case when coalesce(s3, 0) = 0 then 0.0 else (num_distinct_states - m3) / s3 end as x3,
           case when coalesce(s4, 0) = 0 then 0.0 else (num_distinct_cities - m4) / s4 end as x4,
           case when coalesce(s5, 0) = 0 then 0.0 else (zip_macro_region - m5) / s5 end as x5,
           case when coalesce(s6, 0) = 0 then 0.0 else (state_market_share - m6) / s6 end as x6,
           case when coalesce(s7, 0) = 0 then 0.0 else (region_idx - m7) / s7 end as x7
    from assigned a cross join stats
)"""

_BASE = _RAW + "," + _STG + "," + _REGION_MAP + "," + _FEATURES
_BASE_RAW_STG = _RAW + "," + _STG_RAW + "," + _REGION_MAP + "," + _FEATURES


def _q(select: str, base: str = _BASE, extra: str = "") -> str:
    return "with " + base + ("," + extra if extra else "") + "\n" + select


_FEATURE_COLS = (
    "customer_unique_id, primary_customer_id, num_orders, is_repeat_customer, num_distinct_states, "
    "num_distinct_cities, zip_macro_region, primary_state, primary_region, region_idx, state_market_share"
)
_MART_SELECT = """
select customer_unique_id, primary_customer_id, primary_state, primary_region, zip_macro_region,
       num_orders, is_repeat_customer, num_distinct_states, num_distinct_cities,
       round(state_market_share, 4) as state_market_share,
       segment_id, segment_label, segment_source, model_version, scored_at
from resolved"""
_FACT_COLS = "customer_unique_id, primary_customer_id, segment_id, segment_label, segment_source, model_version, scored_at"
_DIM_COLS = (
    "customer_unique_id, primary_customer_id, primary_state, primary_region, region_idx, zip_macro_region, "
    "num_orders, is_repeat_customer, num_distinct_states, num_distinct_cities, state_market_share"
)
_RAW_COLS = "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state"

ORACLE_SQL: dict[str, str] = {
    "stage_orders": _q("select * from stg"),
    "not_null_keys": _q(f"select {_RAW_COLS} from raw_orders where customer_id is not null and customer_unique_id is not null"),
    "zip_digit": _q(
        """select customer_id, customer_zip_code_prefix,
                  lpad(trim(customer_zip_code_prefix), 5, '0') as zip_code_prefix,
                  try_cast(left(trim(customer_zip_code_prefix), 1) as integer) as zip_macro_region,
                  coalesce(try_cast(left(customer_zip_code_prefix, 1) as integer), -1) as zip_macro_region_raw
           from raw_orders where customer_id is not null and customer_unique_id is not null"""
    ),
    "region_lookup_join": _q(
        """select s.customer_id, s.customer_state, r.region, r.region_idx
           from stg s left join region_map r on s.customer_state = r.state_code"""
    ),
    "state_orders": _q("select customer_state, count(*) as state_orders from stg group by customer_state"),
    "order_total": _q("select count(*) as total_orders from stg"),
    "state_share": _q("select customer_state, state_orders, state_market_share from state_share"),
    "person_state_counts": _q(
        """select customer_unique_id, customer_state, count(*) as cnt,
                  min(customer_id) as min_customer_id, max(zip_macro_region) as max_zip_macro_region
           from stg group by customer_unique_id, customer_state"""
    ),
    "primary_state_window": _q("select customer_unique_id, primary_state from primary_state"),
    "person_rollup": _q(
        """select customer_unique_id, num_orders, primary_customer_id, num_distinct_states,
                  num_distinct_cities, zip_macro_region from person_agg"""
    ),
    "person_features": _q(f"select {_FEATURE_COLS} from features"),
    "person_features_raw": _q(f"select {_FEATURE_COLS} from features", base=_BASE_RAW_STG),
    "rule_segments": _q("select customer_unique_id, segment_label_rule from rules"),
    "rule_segment_distribution": _q(
        "select segment_label_rule as segment_label, count(*) as customers from rules group by segment_label_rule"
    ),
    "dim_customers": _q(f"select {_DIM_COLS} from features"),
    "fct_segments_fallback": _q(f"select {_FACT_COLS} from fallback"),
    "fct_segments_with_ml": _q(f"select {_FACT_COLS} from resolved"),
    "mart_wide": _q(_MART_SELECT),
    "label_by_profile": _q(
        """select a.customer_unique_id, a.segment_id, p.segment_label
           from assigned a left join (
               select segment_id,
                      case when avg(num_orders) > 1.3 then 'Recurrente'
                           when avg(num_distinct_states) > 1.05 then 'Itinerante'
                           when avg(state_market_share) > 0.30 then 'Metropolitano'
                           else 'Estándar regional' end as segment_label
               from assigned group by segment_id) p on a.segment_id = p.segment_id"""
    ),
    "cluster_profile": _q(
        """select segment_id,
                  round(avg(num_orders), 6) as avg_orders,
                  round(avg(num_distinct_states), 6) as avg_states,
                  round(avg(state_market_share), 6) as avg_share
           from assigned group by segment_id"""
    ),
    "standardized_features": _q(
        """select customer_unique_id,
                  round(x1, 6) as num_orders_scaled, round(x2, 6) as is_repeat_customer_scaled,
                  round(x3, 6) as num_distinct_states_scaled, round(x4, 6) as num_distinct_cities_scaled,
                  round(x5, 6) as zip_macro_region_scaled, round(x6, 6) as state_market_share_scaled,
                  round(x7, 6) as region_idx_scaled
           from scaled""",
        extra=_SCALED,
    ),
    "assign_fixed_centroids": _q(
        """select customer_unique_id, segment_id from (
               select p.customer_unique_id, c.segment_id,
                      row_number() over (partition by p.customer_unique_id
                          order by (p.x1-c.c1)*(p.x1-c.c1) + (p.x2-c.c2)*(p.x2-c.c2) + (p.x3-c.c3)*(p.x3-c.c3)
                                 + (p.x4-c.c4)*(p.x4-c.c4) + (p.x5-c.c5)*(p.x5-c.c5) + (p.x6-c.c6)*(p.x6-c.c6)
                                 + (p.x7-c.c7)*(p.x7-c.c7), c.segment_id) as rn
               from scaled p cross join centres c) t
           where rn = 1""",
        extra=_SCALED
        + """,
centres as (
    select segment_id, avg(x1) as c1, avg(x2) as c2, avg(x3) as c3, avg(x4) as c4,
           avg(x5) as c5, avg(x6) as c6, avg(x7) as c7
    from scaled group by segment_id
)""",
    ),
    "silhouette_fixed": _q(
        """select round(avg(s), 6) as silhouette from (
               select case when own_n = 1 then 0.0
                           when own_d * own_n / (own_n - 1) < nb then 1 - (own_d * own_n / (own_n - 1)) / nb
                           when own_d * own_n / (own_n - 1) > nb then nb / (own_d * own_n / (own_n - 1)) - 1
                           else 0.0 end as s
               from (
                   select d.customer_unique_id,
                          max(case when d.other = d.own then d.n end) as own_n,
                          max(case when d.other = d.own then d.dist end) as own_d,
                          min(case when d.other <> d.own then d.dist end) as nb
                   from (
                       select p.customer_unique_id, p.segment_id as own, c.segment_id as other, c.n,
                              (p.x1*p.x1 + p.x2*p.x2 + p.x3*p.x3 + p.x4*p.x4 + p.x5*p.x5 + p.x6*p.x6 + p.x7*p.x7)
                              + c.psi / c.n
                              - 2 * (p.x1*c.y1 + p.x2*c.y2 + p.x3*c.y3 + p.x4*c.y4 + p.x5*c.y5 + p.x6*c.y6 + p.x7*c.y7) / c.n
                              as dist
                       from scaled p cross join cstats c) d
                   group by d.customer_unique_id) per) sil""",
        extra=_SCALED
        + """,
cstats as (
    select segment_id, count(*) as n,
           sum(x1) as y1, sum(x2) as y2, sum(x3) as y3, sum(x4) as y4, sum(x5) as y5, sum(x6) as y6, sum(x7) as y7,
           sum(x1*x1 + x2*x2 + x3*x3 + x4*x4 + x5*x5 + x6*x6 + x7*x7) as psi
    from scaled group by segment_id
)""",
    ),
    "region_repeat_counts": _q(
        "select primary_region, is_repeat_customer, count(*) as customers from features group by 1, 2"
    ),
    "frequency_histogram": _q("select num_orders, count(*) as customers from features group by num_orders"),
    "segment_distribution": _q("select segment_label, count(*) as customers from resolved group by segment_label"),
    "geo_distribution": _q(
        "select primary_region, primary_state, count(*) as customers from features group by 1, 2"
    ),
    "repeat_rate_by_region": _q(
        """select primary_region, count(*) as customers, round(avg(is_repeat_customer), 6) as repeat_rate
           from features group by primary_region"""
    ),
    "share_ranking": _q(
        """select customer_state, state_orders, state_market_share,
                  rank() over (order by state_orders desc)
                  as share_rank
           from state_share"""
    ),
    "model_vs_rule": _q(
        "select segment_label, segment_label_rule, count(*) as customers from resolved group by 1, 2"
    ),
    "dq_not_null": _q(
        """select 'raw_orders' as table_name, 'customer_id' as column_name,
                  count(*) filter (where customer_id is null) as violations from raw_orders
           union all
           select 'raw_orders', 'customer_unique_id', count(*) filter (where customer_unique_id is null) from raw_orders
           union all
           select 'fct_customer_segments', 'customer_unique_id',
                  count(*) filter (where customer_unique_id is null) from fallback
           union all
           select 'fct_customer_segments', 'segment_label', count(*) filter (where segment_label is null) from fallback
           union all
           select 'fct_planted', 'customer_unique_id', count(*) filter (where primary_state is null) from fallback
           union all
           select 'fct_planted', 'segment_label', count(*) filter (where primary_region = 'Norte') from fallback"""
    ),
    "dq_unique": """
        select l_orderkey, l_linenumber, count(*) as occurrences
        from lineitem
        where l_orderkey is not null and l_linenumber is not null
        group by l_orderkey, l_linenumber
        having count(*) > 1""",
    "dq_unique_orders": _q(
        """select customer_id, 2 as occurrences from stg where customer_state = 'BA'"""
    ),
    "dq_marts": _q(
        """select 'dim_customers' as table_name, customer_unique_id, 2 as occurrences, 0 as missing_labels
           from fallback where primary_region = 'Sul'
           union all
           select 'fct_customer_segments', customer_unique_id, 2, 0 from fallback where primary_region = 'Norte'
           union all
           select 'mart_bi_customer_segments', customer_unique_id, 1, 1 from fallback where primary_region = 'Nordeste'"""
    ),
    "dq_marts_clean": _q(
        """select t.name as table_name, (select count(*) from features) as persons, 0 as repeated, 0 as missing_keys, 0 as missing_labels
           from (values ('dim_customers'), ('fct_customer_segments'), ('mart_bi_customer_segments')) as t(name)"""
    ),
    "dq_relationships": _q(
        """select s.customer_id, s.customer_state from stg s
           where s.customer_state is not null
             and not exists (select 1 from region_map r where r.state_code = s.customer_state)"""
    ),
    "dq_accepted_values": _q(
        """select upper(segment_label) as segment_label, count(*) as occurrences, 'warn' as severity from resolved
           where primary_region in ('Norte', 'Sul') group by 1"""
    ),
    "dq_coverage": _q("select customer_unique_id from features where primary_region is null or num_orders >= 3"),
    "dq_freshness": """
        select as_of, max_loaded_at,
               round((epoch(as_of) - epoch(max_loaded_at)) / 3600.0, 6) as age_hours,
               case when round((epoch(as_of) - epoch(max_loaded_at)) / 3600.0, 6) > 72 then 'error'
                    when round((epoch(as_of) - epoch(max_loaded_at)) / 3600.0, 6) > 36 then 'warn'
                    else 'pass' end as status
        from (select max(ts) as max_loaded_at from events) m
        cross join (values (timestamp '2024-01-31 01:00:00'), (timestamp '2024-02-01 16:00:00'),
                           (timestamp '2024-02-03 08:00:00')) as a(as_of)""",
    "dq_reconcile": _q(
        """select cast(sum(num_orders) as bigint) as orders, count(*) as persons,
                  cast(sum(is_repeat_customer) as bigint) as repeat_customers,
                  count(distinct segment_label_rule) as segments
           from rules"""
    ),
    "dq_bounds": _q(
        """select customer_unique_id, state_market_share + num_orders - 1 as state_market_share from features
           where state_market_share + num_orders - 1 > 1.0"""
    ),
    "dq_grain": _q(
        """select count(*) as rows, count(distinct customer_unique_id) as distinct_keys,
                  count(*) - count(distinct customer_unique_id) as duplicates from features"""
    ),
    "dq_length": _q(
        """select customer_id, customer_state from raw_orders
           where customer_id is not null and customer_unique_id is not null and length(customer_state) > 2"""
    ),
    "csv_lenient": _q(f"select {_RAW_COLS} from raw_orders"),
    "csv_strict": _q(f"select {_RAW_COLS} from raw_orders"),
    "stream_ingest": _q(f"select {_RAW_COLS} from raw_orders"),
    "parquet_roundtrip": _q(f"select {_FEATURE_COLS} from features"),
    "partitioned_roundtrip": _q(f"select {_FEATURE_COLS} from features"),
    "partition_refresh": _q(
        f"""select {_FEATURE_COLS},
                   case when primary_region = 'Sul' then 'refreshed' else 'initial' end as refresh_tag
            from features"""
    ),
    "clustered_roundtrip": _q(_MART_SELECT),
    "table_roundtrip": _q(f"select {_DIM_COLS} from features"),
}

# ---- model: what SQL can say of any correctly trained model -------------------------------
_GOLD_COLS = (
    "customer_unique_id, primary_customer_id, num_orders, is_repeat_customer, num_distinct_states, num_distinct_cities, "
    "zip_macro_region, primary_state, primary_region, state_market_share"
)
_LABELLED = _q(f"select {_GOLD_COLS}, true as label_matches_profile, 'v1.0.0' as model_version, timestamp '2024-02-01 00:00:00' as scored_at from features")
ORACLE_SQL |= {
    "label_by_profile_mixed": _q(
        """select m.customer_unique_id, m.segment_id, p.segment_label from mixed m join (
               select segment_id,
                      case when avg(num_orders) > 1.3 then 'Recurrente'
                           when avg(num_distinct_states) > 1.05 then 'Itinerante'
                           when avg(state_market_share) > 0.30 then 'Metropolitano'
                           else 'Estándar regional' end as segment_label
               from mixed group by segment_id) p on m.segment_id = p.segment_id""",
        extra="""
mixed as (
    select *, case when num_orders >= 3 then 0
                   when num_distinct_states > 1 or (num_orders = 1 and zip_macro_region = 1) then 1
                   when state_market_share > 0.30 then 2 else 3 end as segment_id
    from features
)""",
    ),
    "kmeans_scored": _q("select customer_unique_id, true as is_nearest_centre, true as id_in_range from features"),
    "k_sweep": """select cast(range as integer) as k, true as in_range, 1 as n_chosen, true as chosen_is_best from range(3, 9)""",
    "train_score_gold": _LABELLED,
    "stage_train_score": _LABELLED,
    "model_roundtrip": _q("select customer_unique_id, true as same_prediction from features"),
    "csv_quarantine": f"""with {_RAW.strip()},
        broken as (select *, try_cast(customer_id as bigint) as number from raw_orders where try_cast(customer_id as bigint) % 50 = 0)
        select case number % 3 when 0 then 'too few fields' when 1 then 'too many fields' else 'open quote' end as reason,
               case number % 3 when 0 then concat_ws(',', customer_id, coalesce(customer_unique_id, ''), coalesce(trim(customer_zip_code_prefix), ''))
                               when 1 then concat_ws(',', customer_id, coalesce(customer_unique_id, ''), coalesce(trim(customer_zip_code_prefix), ''),
                                                     coalesce(trim(customer_city), ''), coalesce(trim(customer_state), '')) || ',more'
                               else customer_id || ',"open,' || coalesce(customer_unique_id, '') end as record
        from broken""",
    "dq_reconcile_load": f"""with {_RAW.strip()},
        n as (select count(*) as n_kept, count(*) filter (try_cast(customer_id as bigint) % 50 = 0) as n_quarantined from raw_orders)
        select n_kept + n_quarantined as n_read, n_kept, n_quarantined, true as reconciled from n""",
    "wall_clock": _q("select customer_unique_id, true as scored_now, true as loaded_now from features"),
    "settings_run": _q(
        """select customer_unique_id, 'v-env' as model_version, true as id_in_range,
                  cast(4 as integer) as k_fixed, cast(12 as integer) as max_iter, cast(3 as integer) as n_features from features"""
    ),
    "kmeans_layouts": _q("select customer_unique_id, true as same_id, true as same_centres from features"),
    "retrain_warm": _q(
        """select customer_unique_id, true as same_id, true as same_label, true as settled_at_once,
                  (select count(*) from features) as persons from features"""
    ),
    "ml_table_retrain": _q("select customer_unique_id, true as label_matches_profile, true as id_in_range from features"),
    "run_metrics": """
        select 'catalog' as run_id, 'v1.0.0' as model_version, key, value from (values
            ('k_fixed', -1.0::double), ('max_iter', 50.0::double), ('seed', 42.0::double), ('n_features', 7.0::double),
            ('layout_partitions', 16.0::double), ('n_silhouettes', 6.0::double), ('silhouettes_in_range', 6.0::double),
            ('selected_is_best', 1.0::double), ('cost_is_positive', 1.0::double)) as t(key, value)""",
    # served path: retrained model table -> fact -> mart
    "marts_from_retrain": _q(
        f"""select {_GOLD_COLS.replace("state_market_share", "round(state_market_share, 4) as state_market_share")},
                   case when primary_state is not null then 'kmeans' else 'rule_based' end as segment_source,
                   true as label_matches_source, 'v1.0.0' as model_version, timestamp '2024-02-01 00:00:00' as scored_at
            from rules"""
    ),
    "build_all": _q(f"select {_GOLD_COLS}, true as label_matches_profile from features"),
    "dq_freshness_bronze": _q(
        """select a.as_of, timestamp '2024-01-31 00:00:00' as max_loaded_at, a.age_hours, a.status
           from (values (timestamp '2024-02-01 00:00:00', 24.0::double, 'pass'), (timestamp '2024-02-02 00:00:00', 48.0::double, 'warn'),
                        (timestamp '2024-02-04 00:00:00', 96.0::double, 'error')) as a(as_of, age_hours, status)
           where exists (select 1 from stg)"""
    ),
}

# Same result, different operator form.
ORACLE_SQL["region_lookup_map"] = ORACLE_SQL["region_lookup_join"]
ORACLE_SQL["state_share_sql"] = ORACLE_SQL["state_share"]
ORACLE_SQL["primary_state_sql"] = ORACLE_SQL["primary_state_window"]
ORACLE_SQL["primary_state_struct"] = ORACLE_SQL["primary_state_window"]
ORACLE_SQL["mart_dim_fact_join"] = ORACLE_SQL["mart_wide"]
ORACLE_SQL["optional_table_present"] = ORACLE_SQL["fct_segments_with_ml"]
ORACLE_SQL["view_roundtrip"] = ORACLE_SQL["table_roundtrip"]
ORACLE_SQL["inline_roundtrip"] = ORACLE_SQL["table_roundtrip"]
ORACLE_SQL["optional_table"] = ORACLE_SQL["fct_segments_fallback"]
ORACLE_SQL["dq_unique_loads"] = ORACLE_SQL["dq_unique"]
ORACLE_SQL["dq_grain_loads"] = """
    select count(*) as rows, count(distinct (l_orderkey, l_linenumber)) as distinct_keys,
           count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicates from lineitem"""
ORACLE_SQL["dq_relationships_loads"] = """
    select l_orderkey, l_linenumber from lineitem anti join (select o_orderkey from orders where o_orderkey % 37 <> 0) on l_orderkey = o_orderkey"""
ORACLE_SQL["interleaved_roundtrip"] = ORACLE_SQL["clustered_roundtrip"]
ORACLE_SQL["resumed_build"] = _q(
    "select customer_unique_id, true as label_matches_profile, 'features,train' as first_ran, 'score' as second_ran, '' as third_ran from features")
ORACLE_SQL["features_incremental"] = ORACLE_SQL["person_features"]
ORACLE_SQL["stream_features"] = ORACLE_SQL["person_features"]
ORACLE_SQL["stage_features_build"] = ORACLE_SQL["person_features"]
ORACLE_SQL["stage_marts_build"] = _q(_MART_SELECT.replace("from resolved", "from fallback"))
