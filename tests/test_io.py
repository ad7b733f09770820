"""Sources and sinks: lenient/strict CSV, load timestamp, round trips, overwrite modes."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from segmark.sinks import writers
from segmark.sources import raw as rawsrc
from segmark.sources.tables import empty_typed, optional_table, read_dataset

PLANTED = "\n".join(
    [
        "customer_id,customer_unique_id,zip,city,state",
        '"a","A","01001","x, y","SP"',
        "b,B",
        "c,C,1,2,RJ,extra",
        ",,3,c,SP",
        'd,D,"00 ""q""",e,SP',
    ]
) + "\n"


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w") as fh:
        fh.write(text)
    return path


def test_lenient_csv_consistent_counts(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "csv"), PLANTED)
    df = rawsrc.read_raw_csv(spark, path)
    rows = df.collect()
    assert len(rows) == 3
    # count() and a one-column aggregate agree with the full parse (no pruning effect).
    assert df.count() == 3
    assert df.groupBy("customer_state").count().agg({"count": "sum"}).collect()[0][0] == 3
    byid = {r.customer_id: r for r in rows}
    assert byid["a"].customer_city == "x, y"
    assert byid["d"].customer_zip_code_prefix == '00 "q"'
    assert byid[None].customer_unique_id is None


def test_strict_csv_fails_and_nulls(spark, tmp_dir):
    path = _write(os.path.join(tmp_dir, "csv"), PLANTED)
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        rawsrc.read_raw_csv_strict(spark, path).collect()
    ok = _write(os.path.join(tmp_dir, "ok"), "h1,h2,h3,h4,h5\na,A,NULL,,SP\n")
    r = rawsrc.read_raw_csv_strict(spark, ok).collect()[0]
    assert r.customer_zip_code_prefix is None and r.customer_city is None and r.customer_state == "SP"


def test_loaded_at(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    df = rawsrc.with_loaded_at(spark.createDataFrame([("a",)], "x string"), at)
    assert df.collect()[0]._loaded_at == at


def test_partition_overwrite_modes(spark, tmp_dir):
    df = spark.createDataFrame([(1, "N"), (2, "S")], "id int, primary_region string")
    new = spark.createDataFrame([(3, "N")], "id int, primary_region string")
    static_path, dyn_path = os.path.join(tmp_dir, "static"), os.path.join(tmp_dir, "dynamic")
    for p in (static_path, dyn_path):
        writers.write_table(df, p, partition_by=["primary_region"])
    writers.write_table(new, static_path, partition_by=["primary_region"], overwrite="static")
    writers.write_table(new, dyn_path, partition_by=["primary_region"], overwrite="dynamic")
    assert sorted(r.id for r in read_dataset(spark, static_path).collect()) == [3]
    assert sorted(r.id for r in read_dataset(spark, dyn_path).collect()) == [2, 3]


def test_partition_pruning(spark, tmp_dir):
    df = spark.createDataFrame([(1, "N"), (2, "S")], "id int, primary_region string")
    p = os.path.join(tmp_dir, "parts")
    writers.write_table(df, p, partition_by=["primary_region"])
    q = read_dataset(spark, p).where("primary_region = 'S'")
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "PartitionFilters: [isnotnull(primary_region" in buf.getvalue()
    assert [r.id for r in q.collect()] == [2]


def test_clustered_layout_sorted_files(spark, tmp_dir):
    df = spark.range(1000).selectExpr("cast(id % 7 as string) as primary_region", "cast(id % 5 as int) as segment_id")
    p = os.path.join(tmp_dir, "clustered")
    writers.write_table(writers.clustered(df, ["primary_region", "segment_id"], 4), p, rebalance=False)
    back = read_dataset(spark, p)
    assert back.count() == 1000
    per_file = back.selectExpr("input_file_name() as f", "primary_region").groupBy("f").agg({"primary_region": "min"})
    assert per_file.count() <= 4


def test_optional_and_empty(spark):
    schema = "customer_unique_id string, segment_id int, segment_label string"
    assert optional_table(spark, "segmark_does_not_exist", schema).count() == 0
    spark.createDataFrame([("a", 1, "x")], schema).createOrReplaceTempView("segmark_ml_present")
    assert optional_table(spark, "segmark_ml_present", schema).count() == 1
    assert empty_typed(spark, schema).columns == ["customer_unique_id", "segment_id", "segment_label"]


def test_materialize_modes(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    assert writers.materialize(df, "segmark_view_t", "view").count() == 1
    assert writers.materialize(df, "segmark_tab_t", "table", path=os.path.join(tmp_dir, "tab")).count() == 1
    assert writers.materialize(df, "unused", "ephemeral") is df


def test_clustered_layout_splits_a_hot_key(spark, tmp_dir):
    # One (region, segment) pair holds every row: it still spreads over several files.
    df = spark.range(4000).selectExpr(
        "'Sudeste' as primary_region", "0 as segment_id", "cast(id as string) as customer_unique_id"
    )
    p = os.path.join(tmp_dir, "hot")
    writers.write_table(writers.clustered(df, ["primary_region", "segment_id"], 4), p, rebalance=False)
    files = read_dataset(spark, p).selectExpr("input_file_name() as f").distinct().count()
    assert files == 4


def _csv(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


HEAD = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"


def test_quarantine_keeps_what_the_lenient_reader_drops(spark, tmp_dir):
    from segmark.operators.quality import reconcile_load
    from segmark.sources import raw as rawsrc

    folder = os.path.join(tmp_dir, "in")
    _csv(folder, "a.csv", [HEAD, 'a,A,1,"rio, centro",RJ', "", "b,B", '"c",C,3,"say ""hi""",SP', "d,D,4,x,SP,more"])
    _csv(folder, "b.csv", [HEAD, "   ", 'e,"E,5,y,SP', "f,F,,,"])
    _csv(folder, "c.csv", [HEAD])
    landed = rawsrc.land_raw_csv(spark, folder, os.path.join(tmp_dir, "out"))
    assert sorted(map(str, landed.kept.collect())) == sorted(map(str, rawsrc.read_raw_csv(spark, folder).collect()))
    assert sorted(r.customer_id for r in landed.kept.collect()) == ["a", "c", "f"]
    bad = {(os.path.basename(r.source_file), r.reason, r.record) for r in landed.quarantined.collect()}
    assert bad == {("a.csv", "too few fields", "b,B"), ("a.csv", "too many fields", "d,D,4,x,SP,more"), ("b.csv", "open quote", 'e,"E,5,y,SP')}
    counts = reconcile_load(rawsrc.data_lines(spark, folder), landed.kept, landed.quarantined).first()
    assert tuple(counts) == (6, 3, 3, True)
    assert not reconcile_load(rawsrc.data_lines(spark, folder), landed.kept.limit(1), landed.quarantined).first().reconciled
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        rawsrc.read_raw_csv_strict(spark, folder).collect()


def test_features_stage_with_quarantine(spark, tmp_dir, monkeypatch):
    from segmark.params import Paths, Settings
    from segmark.plans import stages
    from segmark.sources.tables import read_dataset

    folder = os.path.join(tmp_dir, "in")
    _csv(folder, "a.csv", [HEAD, "a,A,1,rio,RJ", "b,B", "c,A,1,rio,RJ"])
    settings = Settings(paths=Paths.under(os.path.join(tmp_dir, "out"), folder, quarantine=True))
    assert stages.build_features(spark, settings) == 1
    assert read_dataset(spark, settings.paths.quarantine).where("cast(malformed as boolean)").count() == 1
    real = stages.data_lines
    monkeypatch.setattr(stages, "data_lines", lambda s, p: real(s, p).selectExpr("source_file", "n_lines + 1 as n_lines"))
    with pytest.raises(RuntimeError, match="do not add up"):
        stages.build_features(spark, settings)


def test_interleaved_layout_skips_files_by_either_key(spark, tmp_dir):
    """Files whose min/max range holds a value, for each key alone, against the layout by key order."""
    rows = spark.range(40_000).selectExpr(
        "cast(id % 8 as int) as segment_id", "concat('region ', cast(floor(id / 8) % 7 as int)) as primary_region", "cast(id as string) as customer_unique_id")
    rows = rows.unionByName(spark.createDataFrame([(None, None, "x")], rows.schema))
    keys = ["primary_region", "segment_id"]
    share = {}
    for name, laid in (("ordered", writers.clustered(rows, keys, 28)), ("interleaved", writers.interleaved(rows, keys, 28))):
        path = os.path.join(tmp_dir, name)
        writers.write_table(laid, path, rebalance=False)
        back = read_dataset(spark, path)
        assert sorted(map(str, back.select(*rows.columns).collect())) == sorted(map(str, rows.collect()))
        for key in keys:
            hit = writers.files_per_value(back, key).collect()
            assert {r.value for r in hit} == {str(r[0]) for r in rows.select(key).distinct().collect() if r[0] is not None}
            share[name, key] = max(r.files_holding / r.files for r in hit)
    assert share["interleaved", "segment_id"] <= 0.5 < share["ordered", "segment_id"]
    assert share["interleaved", "primary_region"] <= 0.5


def test_interleaving_many_values(spark):
    rows = spark.range(4096 * 3).selectExpr("id % 16 as a", "cast(floor(id / 16) % 16 as double) as b", "concat('v', 10 + cast(floor(id / 256) % 16 as int)) as c")
    z = writers.interleaved_key(rows, ["a", "b", "c"], bits=4)
    got = rows.select(z.alias("z")).agg(F.countDistinct("z").alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")).first()
    assert tuple(got) == (4096, 0, 4095)  # every combination has a number of its own
    many = spark.range(20_000).selectExpr("id as a")
    few = many.select(writers.interleaved_key(many, ["a"], bits=5).alias("z"), "a").groupBy("z").agg(F.count("a").alias("n"), F.min("a"), F.max("a")).orderBy("z").collect()
    assert len(few) == 32 and all(200 < r.n < 1600 for r in few) and all(x[3] < y[2] for x, y in zip(few, few[1:]))
    empty = rows.where("false")
    assert writers.interleaved(empty, ["a", "b"]).count() == 0


def test_interleaved_key_works_out_each_position_once(spark):
    rows = spark.range(200).select((F.col("id") % 40).alias("a"), F.when(F.col("id") % 7 > 0, (F.col("id") % 6).cast("string")).alias("b"))
    keyed = rows.select("a", "b", writers.interleaved_key(rows, ["a", "b"]).alias("z"))
    assert keyed._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") <= 1
    for r in keyed.collect():
        places = [r["a"], 0 if r["b"] is None else int(r["b"])]
        assert r["z"] == sum((at >> bit & 1) << (2 * bit + 1 - i) for bit in range(8) for i, at in enumerate(places))
