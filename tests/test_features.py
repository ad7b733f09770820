"""Person features on hand-made orders."""
from __future__ import annotations

from conftest import raw

from segmark.operators.features import (
    customer_features,
    person_rollup,
    primary_state_sql,
    primary_state_struct,
    primary_state_window,
    state_share,
)
from segmark.operators.rules import rule_segments
from segmark.operators.staging import stage_orders


def test_features_of_the_fixture(raw_df, features_of):
    """Every column of every person, worked out by hand."""
    got = features_of(raw_df)
    want = {
        # orders tie between BA and SC: the first in the alphabet; two spellings are one city
        "mila": ("n-02", 2, 1, 2, 1, 8, "BA", "Nordeste", 1, 1 / 9),
        "otto": ("n-05", 3, 1, 1, 2, 6, "CE", "Nordeste", 1, 2 / 9),
        "rute": ("n-03", 1, 0, 0, 0, -1, None, None, -1, 0.0),
        # a state outside the dimension keeps its share but has no region
        "ugo": ("n-08", 1, 0, 1, 1, 3, "QQ", None, -1, 1 / 9),
        "vera": ("n-01", 2, 1, 1, 1, 7, "DF", "Centro-Oeste", 0, 2 / 9),
    }
    assert {k: tuple(r)[1:] for k, r in got.items()} == want


def test_uncleaned_text_changes_cities_states_and_digits(raw_df, features_of):
    got = features_of(raw_df, clean=False)
    assert got["mila"].num_distinct_cities == 2 and got["otto"].num_distinct_cities == 3
    assert got["vera"].num_distinct_states == 2 and got["vera"].primary_state == "DF"
    assert got["mila"].zip_macro_region == 8


def test_tie_prefers_known_state(spark, features_of):
    # One order in a NULL state, one in SP: SP wins the tie (known before unknown).
    f = features_of(raw(spark, [("o1", "p", "1", "a", None), ("o2", "p", "2", "b", "SP")]))
    assert f["p"].primary_state == "SP"
    # Equal counts in two known states: alphabetical.
    f = features_of(raw(spark, [("o1", "q", "1", "a", "SP"), ("o2", "q", "2", "b", "BA")]))
    assert f["q"].primary_state == "BA"


def test_primary_state_forms_agree(spark):
    df = stage_orders(
        raw(
            spark,
            [
                ("o1", "p", "1", "a", None),
                ("o2", "p", "2", "b", "SP"),
                ("o3", "q", "1", "a", "SP"),
                ("o4", "q", "1", "a", "BA"),
                ("o5", "r", "1", "a", "RJ"),
                ("o6", "r", "1", "a", "RJ"),
                ("o7", "r", "1", "a", "SP"),
            ],
        )
    )
    want = {"p": "SP", "q": "BA", "r": "RJ"}
    for fn in (primary_state_window, primary_state_sql, primary_state_struct):
        assert {r.customer_unique_id: r.primary_state for r in fn(df).collect()} == want


def test_zip_cleaning(spark):
    stg = stage_orders(
        raw(
            spark,
            [
                ("o1", "p", "1001", "a", "SP"),
                ("o2", "p", "", "a", "SP"),
                ("o3", "p", "x1", "a", "SP"),
                ("o4", "p", None, "a", "SP"),
                ("o5", "p", " 42", "a", "SP"),
            ],
        )
    )
    rows = {r.customer_id: r for r in stg.collect()}
    assert rows["o1"].zip_code_prefix == "01001" and rows["o1"].zip_macro_region == 1
    assert rows["o2"].zip_macro_region is None and rows["o3"].zip_macro_region is None
    assert rows["o4"].zip_macro_region is None
    assert rows["o5"].zip_macro_region == 4 and rows["o5"].zip_code_prefix == "00042"


def test_unknown_and_null_states(spark, features_of):
    f = features_of(
        raw(
            spark,
            [
                ("o1", "u", "1", "a", "XX"),
                ("o2", "n", "1", "a", None),
                ("o3", "s", "1", "a", "SP"),
                ("o4", "s2", "1", "a", "sp "),
            ],
        )
    )
    assert f["u"].primary_state == "XX" and f["u"].primary_region is None
    assert f["u"].state_market_share == 0.25 and f["u"].region_idx == -1
    assert f["n"].primary_state is None and f["n"].state_market_share == 0.0
    assert f["s"].state_market_share == 0.5  # 'sp ' is cleaned to SP
    assert f["n"].zip_macro_region == 1


def test_cities_counted_after_cleaning(spark, features_of):
    rows = [("o1", "p", "1", "sao paulo", "SP"), ("o2", "p", "1", " SAO PAULO ", "SP"), ("o3", "p", "1", None, "SP")]
    assert features_of(raw(spark, rows))["p"].num_distinct_cities == 1
    assert features_of(raw(spark, rows), clean=False)["p"].num_distinct_cities == 2


def test_null_keys_dropped(spark, features_of):
    f = features_of(raw(spark, [(None, "p", "1", "a", "SP"), ("o1", None, "1", "a", "SP"), ("o2", "q", "1", "a", "SP")]))
    assert list(f) == ["q"]


def test_rollup_matches_features(raw_df):
    stg = stage_orders(raw_df)
    a = {r.customer_unique_id: r for r in person_rollup(stg).collect()}
    b = {r.customer_unique_id: r for r in customer_features(stg).collect()}
    for k in a:
        for c in ("num_orders", "primary_customer_id", "num_distinct_states", "num_distinct_cities"):
            assert a[k][c] == b[k][c]


def test_share_sums_to_one(raw_df):
    assert abs(sum(r.state_market_share for r in state_share(stage_orders(raw_df)).collect()) - 1.0) < 1e-12


def test_itinerant_rule_unreachable(spark):
    # >= 2 states implies >= 2 orders, which an earlier branch takes.
    rows = [("o1", "p", "1", "a", "SP"), ("o2", "p", "1", "a", "RJ"), ("o3", "q", "1", "a", "SP")]
    feats = customer_features(stage_orders(raw(spark, rows)))
    labels = {r.customer_unique_id: r.segment_label_rule for r in rule_segments(feats).collect()}
    assert labels == {"p": "Recurrente", "q": "Metropolitano"}
    assert "Itinerante" not in labels.values()


def test_hot_person_third_of_rows(spark, features_of):
    # One person holds a third of all orders, spread over states and cities.
    rows = [(f"h{i}", "hot", f"{i % 10}0000", f"city {i % 7}", ["SP", "RJ", "BA"][i % 3]) for i in range(300)]
    rows += [(f"o{i}", f"p{i}", "10000", "x", "SP") for i in range(600)]
    f = features_of(raw(spark, rows))
    h = f["hot"]
    assert (h.num_orders, h.num_distinct_states, h.num_distinct_cities) == (300, 3, 7)
    assert h.primary_state == "BA" and h.zip_macro_region == 9  # 100 each: A-Z tie-break
    assert h.primary_customer_id == "h0"
    assert abs(h.state_market_share - 100 / 900) < 1e-12
    assert len(f) == 601


def test_region_indices_alphabetical_and_seeded(spark):
    from segmark.sources.dims import state_dim

    rows = {r.state_code: r for r in state_dim(spark).collect()}
    assert len(rows) == 27
    alpha = {r.region: r.region_idx for r in rows.values()}
    seed = {r.region: r.region_idx_seed for r in rows.values()}
    assert alpha == {"Centro-Oeste": 0, "Nordeste": 1, "Norte": 2, "Sudeste": 3, "Sul": 4}
    assert seed == {"Norte": 0, "Nordeste": 1, "Centro-Oeste": 2, "Sudeste": 3, "Sul": 4}
    assert {s for s, r in rows.items() if r.is_capital_state} == {"DF", "RJ", "SP"}


def test_duplicate_orders_count_twice(spark, features_of):
    # num_orders is count(*), not distinct orders; uniqueness is a separate check (Q2).
    f = features_of(raw(spark, [("o1", "p", "1", "a", "SP"), ("o1", "p", "1", "a", "SP")]))
    assert f["p"].num_orders == 2 and f["p"].is_repeat_customer == 1
