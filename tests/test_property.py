"""Person features on random small order sets equal a brute-force computation."""
from __future__ import annotations

from collections import Counter

from conftest import raw
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from segmark.operators.features import customer_features
from segmark.operators.staging import stage_orders
from segmark.sources.dims import REGION_INDEX, STATE_REGION_ROWS

REGION = {s: r for s, r, _, _ in STATE_REGION_ROWS}

row = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.sampled_from(["01001", "1", "x1", "", None, " 42", "9"]),
    st.sampled_from(["x", "X ", " y", "sao paulo", "SAO  PAULO", None]),
    st.sampled_from(["SP", "sp ", "RJ", "XX", None, "BA", " rj"]),
)


def _initcap(s: str) -> str:
    return " ".join(w[:1].upper() + w[1:] for w in s.lower().split(" "))


def brute(rows):
    stg = []
    for cid, person, z, city, state in rows:
        if cid is None or person is None:
            continue
        zt = z.strip(" ") if z is not None else None
        digit = int(zt[0]) if zt and zt[0].isdigit() else None
        stg.append((cid, person, digit, _initcap(city.strip(" ")) if city is not None else None,
                    state.strip(" ").upper() if state is not None else None))
    total = len(stg)
    per_state = Counter(s for *_, s in stg)
    out = {}
    for p in {r[1] for r in stg}:
        mine = [r for r in stg if r[1] == p]
        counts = Counter(r[4] for r in mine)
        primary = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[0][0]
        digits = [r[2] for r in mine if r[2] is not None]
        region = REGION.get(primary) if primary is not None else None
        out[p] = (
            min(r[0] for r in mine),
            len(mine),
            int(len(mine) > 1),
            len({r[4] for r in mine if r[4] is not None}),
            len({r[3] for r in mine if r[3] is not None}),
            max(digits) if digits else -1,
            primary,
            region,
            REGION_INDEX[region] if region else -1,
            per_state[primary] / total if primary is not None else 0.0,
        )
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=14))
def test_features_match_brute_force(spark, rows):
    raw_rows = [(f"o{i:02d}", p, z, c, s) for i, (p, z, c, s) in enumerate(rows)]
    got = {
        r.customer_unique_id: (
            r.primary_customer_id, r.num_orders, r.is_repeat_customer, r.num_distinct_states,
            r.num_distinct_cities, r.zip_macro_region, r.primary_state, r.primary_region, r.region_idx,
            r.state_market_share,
        )
        for r in customer_features(stage_orders(raw(spark, raw_rows))).collect()
    }
    assert got == brute(raw_rows)


person = st.tuples(
    st.integers(min_value=1, max_value=5),  # num_orders
    st.integers(min_value=1, max_value=3),  # distinct states
    st.sampled_from([0.1, 0.3, 0.31, 0.9]),  # share
    st.sampled_from([None, (0, "Recurrente"), (1, None), (2, "Metropolitano")]),  # model row
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(person, min_size=1, max_size=10))
def test_resolution_matches_brute_force(spark, people):
    from segmark.operators import marts

    feats = spark.createDataFrame(
        [(f"p{i}", f"o{i}", n, int(n > 1), st_, 1, 1, "SP", "Sudeste", 3, sh) for i, (n, st_, sh, _) in enumerate(people)],
        "customer_unique_id string, primary_customer_id string, num_orders long, is_repeat_customer int, "
        "num_distinct_states long, num_distinct_cities long, zip_macro_region int, primary_state string, "
        "primary_region string, region_idx int, state_market_share double",
    )
    ml_rows = [(f"p{i}", m[0], m[1]) for i, (*_, m) in enumerate(people) if m is not None]
    ml_tab = spark.createDataFrame(ml_rows, marts.ML_SCHEMA)
    got = {r.customer_unique_id: (r.segment_id, r.segment_label, r.segment_source)
           for r in marts.fct_customer_segments(feats, ml_tab, "v").collect()}

    def rule(n, states, share):
        if n >= 3:
            return "Recurrente alto"
        if n > 1:
            return "Recurrente"
        if states > 1:
            return "Itinerante"
        if share > 0.30:
            return "Metropolitano"
        return "Estándar regional"

    want = {}
    for i, (n, states, share, m) in enumerate(people):
        if m is None:
            want[f"p{i}"] = (-1, rule(n, states, share), "rule_based")
        else:
            want[f"p{i}"] = (m[0], m[1] if m[1] is not None else rule(n, states, share), "kmeans")
    assert got == want
