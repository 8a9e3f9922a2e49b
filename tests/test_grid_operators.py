"""Edge cases of the grid operators on small hand-made frames, and properties against numpy."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.functions.grid import COARSE, DEPTHS, TARGET, Grid, axis
from gridspark.operators import align, collocate, crop, mask, merge, metrics, normalize, qa, regrid, split, tensor, vertical
from gridspark.sources import ingest, sinks, synthetic

D = dt.date
SMALL = Grid(lat0=0.0, lon0=0.0, step=0.5, ny=5, nx=5)


def native(spark, values, skip=()):
    """A 3 by 3 product with step 1 on one day."""
    rows = [(D(2020, 1, 1), i, j, float(values(i, j))) for i in range(3) for j in range(3) if (i, j) not in skip]
    return spark.createDataFrame(rows, "date date, src_lat_idx int, src_lon_idx int, v double")


def weights(spark, grid=SMALL):
    src = axis(spark, 0.0, 1.0, 3)
    lat, lon = grid.axes(spark)
    return regrid.axis_weights(src, lat), regrid.axis_weights(src, lon)


def dense(spark, df, grid=SMALL):
    out = regrid.onto_grid(df, grid).collect()
    a = np.full((grid.ny, grid.nx), np.nan)
    for r in out:
        a[r.lat_idx, r.lon_idx] = np.nan if r.v is None else r.v
    assert len(out) == grid.ny * grid.nx
    return a


def test_plane_is_reproduced(spark):
    a = dense(spark, regrid.regrid(native(spark, lambda i, j: 2 + 3 * i - 5 * j), ["v"], *weights(spark)))
    want = [[2 + 1.5 * i - 2.5 * j for j in range(5)] for i in range(5)]
    assert np.allclose(a, want)


def test_missing_corner_and_node_hit(spark):
    a = dense(spark, regrid.regrid(native(spark, lambda i, j: i + j, skip={(0, 0)}), ["v"], *weights(spark)))
    assert math.isnan(a[0, 0]) and math.isnan(a[1, 1]) and math.isnan(a[0, 1])
    assert a[0, 2] == 1 and a[2, 2] == 2 and not math.isnan(a[1, 2])


def test_missing_value_is_like_an_absent_node(spark):
    df = native(spark, lambda i, j: i + j).withColumn("v", F.when((F.col("src_lat_idx") > 0) | (F.col("src_lon_idx") > 0), F.col("v")))
    a = dense(spark, regrid.regrid(df, ["v"], *weights(spark)))
    assert math.isnan(a[0, 0]) and a[0, 2] == 1


def test_outside_the_hull_is_missing_but_present(spark):
    wide = Grid(lat0=-1.0, lon0=0.0, step=0.5, ny=8, nx=5)
    src = axis(spark, 0.0, 1.0, 3)
    lat, lon = wide.axes(spark)
    a = dense(spark, regrid.regrid(native(spark, lambda i, j: 1), ["v"], regrid.axis_weights(src, lat), regrid.axis_weights(src, lon)), wide)
    assert np.isnan(a[:2]).all() and np.isnan(a[7]).all() and (a[2:7] == 1).all()


def test_descending_axis(spark):
    src = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 0.0)], "idx int, coord double")
    lat, lon = SMALL.axes(spark)
    w = regrid.axis_weights(src, lat), regrid.axis_weights(axis(spark, 0.0, 1.0, 3), lon)
    a = dense(spark, regrid.regrid(native(spark, lambda i, j: 2 - i), ["v"], *w))
    assert np.allclose(a[:, 0], [0, 0.5, 1, 1.5, 2])


def test_given_weights_agree_with_bilinear(spark):
    lat, lon = weights(spark)
    product = lat.select(F.col("src_idx").alias("src_lat_idx"), F.col("dst_idx").alias("lat_idx"), F.col("w").alias("a"), F.lit(1).alias("k")).join(lon.select(F.col("src_idx").alias("src_lon_idx"), F.col("dst_idx").alias("lon_idx"), F.col("w").alias("b"), F.lit(1).alias("k")), "k")
    table = product.select("src_lat_idx", "src_lon_idx", "lat_idx", "lon_idx", (F.col("a") * F.col("b")).alias("w"))
    df = native(spark, lambda i, j: i * 7 + j, skip={(2, 1)})
    a, b = dense(spark, regrid.regrid(df, ["v"], lat, lon)), dense(spark, regrid.regrid_with_weights(df, ["v"], table))
    assert np.allclose(a, b, equal_nan=True)


def test_nearest_index_ties_go_down(spark):
    got = {r.dst_idx: r.src_idx for r in regrid.nearest_index(axis(spark, 0.0, 1.0, 3), SMALL.axes(spark)[0]).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}


def test_results_do_not_depend_on_partitions(spark):
    df = native(spark, lambda i, j: i * i + j)
    seen = []
    for n in ("1", "4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(dense(spark, regrid.regrid(df.repartition(int(n)), ["v"], *weights(spark))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert np.allclose(seen[0], seen[1]) and np.allclose(seen[0], seen[2])


def test_surface_padding_and_depth_range(spark):
    levels = spark.createDataFrame([(0, 0.494), (1, 10.0), (2, 60.0)], "idx int, coord double")
    rows = spark.createDataFrame([(1, 0, 20.0), (1, 1, 10.0), (1, 2, 5.0)], "k int, src_depth_idx int, temp double")
    got = {DEPTHS[r.depth_idx]: r.temp for r in vertical.interpolate_depths(rows, "temp", vertical.depth_weights(levels), ["k"]).collect()}
    assert got[0] == 20.0 and got[10] == 10.0 and got[50] == pytest.approx(6.0)
    assert 75 not in got  # deeper than the last level: no weights, so missing


def test_profile_cases_against_numpy(spark):
    rng = np.random.default_rng(3)
    cases = {1: [(300.0, 5.0), (0.0, 20.0), (100.0, 10.0)], 2: [(10.0, 1.0)], 3: [(10.0, 1.0), (None, 2.0), (20.0, None)], 4: [(5.0, 1.0), (5.0, 3.0), (20.0, 4.0)], 5: [(float(p), float(t)) for p, t in zip(rng.permutation(1100)[:20], rng.random(20))], 6: []}
    levels = spark.createDataFrame([(k, p, t) for k, v in cases.items() for p, t in v], "profile_idx long, pres double, temp double")
    profiles = spark.createDataFrame([(k,) for k in cases], "profile_idx long")
    got = {(r.profile_idx, r.depth_m): r.temp for r in vertical.profile_at_depths(levels, profiles).collect()}
    assert len(got) == 15 * len(cases)
    for k, v in cases.items():
        ok = sorted((p, t) for p, t in v if p is not None and t is not None)
        pts = {p: np.mean([t for q, t in ok if q == p]) for p, _ in ok}
        for d in DEPTHS:
            x, y = list(pts), list(pts.values())
            want = None if len(x) < 2 or not x[0] <= d <= x[-1] else np.interp(d, x, y)
            assert (got[k, d] is None) == (want is None), (k, d)
            if want is not None:
                assert got[k, d] == pytest.approx(want)


def test_nearest_cell(spark):
    rows = spark.createDataFrame([(5.125, 45.0), (5.126, 45.125), (30.0, 105.0), (2.0, 200.0), (17.49, 60.2)], "lat double, lon double")
    lat, lon = TARGET.nearest(F.col("lat"), F.col("lon"))
    got = [tuple(r) for r in rows.select(lat, lon).collect()]
    lats, lons = np.linspace(5, 30, 101), np.linspace(45, 105, 241)
    want = [(int(np.argmin(abs(lats - a))), int(np.argmin(abs(lons - b)))) for a, b in [(5.125, 45.0), (5.126, 45.125), (30.0, 105.0), (2.0, 200.0), (17.49, 60.2)]]
    assert got == want and got[0][0] == 0


def test_nearest_date(spark):
    axis_ = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 2),), (D(2020, 1, 5),)], "date date")
    asked = {dt.datetime(2020, 1, 1, 11, 59): D(2020, 1, 1), dt.datetime(2020, 1, 1, 12): D(2020, 1, 2), dt.datetime(2020, 1, 1, 13): D(2020, 1, 2), dt.datetime(2020, 1, 3, 11): D(2020, 1, 2), dt.datetime(2020, 1, 3, 13): D(2020, 1, 5), dt.datetime(2021, 1, 1): D(2020, 1, 5)}
    times = spark.createDataFrame([(t,) for t in asked], "juld timestamp")
    got = {r.juld: r.grid_date for r in collocate.nearest_dates(times, axis_).collect()}
    assert got == asked
    same = {r.juld: r.grid_date for r in collocate.nearest_dates(times, axis_, mode="same_day").collect()}
    assert same == {t: t.date() for t in asked if t.date() in (D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 5))}


def test_collocate_keeps_rows_without_grid_data(spark):
    p = spark.createDataFrame([(7, " 12 ", dt.datetime(2020, 1, 1, 3), 10.0, 50.0), (8, None, dt.datetime(2020, 1, 1), 40.0, 50.0), (9, None, dt.datetime(2020, 1, 1), 5.0, 45.0)], "profile_idx long, float_id string, juld timestamp, lat double, lon double")
    lv = spark.createDataFrame([(7, 0.0, 20.0), (7, 10.0, 18.0)], "profile_idx long, pres double, temp double")
    t = spark.createDataFrame([(D(2020, 1, 1), 0, 0, 20, 20, 19.5)], "date date, depth_idx int, depth_m int, lat_idx int, lon_idx int, temp double")
    rows = collocate.collocate(p, lv, t).collect()
    assert len(rows) == 30
    top = next(r for r in rows if r.float_id == "12" and r.depth_m == 0)
    assert (top.argo_temp, top.glorys_temp, top.model_prediction, top.date) == (20.0, 19.5, None, "2020-01-01")
    assert {r.float_id for r in rows} == {"12", "profile_9"}
    assert len(collocate.collocate(p, lv, None).where("glorys_temp is null").collect()) == 30


def test_stats_leakage_and_constant_channel(spark):
    def stats(test_value):
        rows = [(D(2020, 1, 1), "train", True, 1.0, 5.0), (D(2020, 1, 2), "train", True, 3.0, 5.0), (D(2020, 1, 2), "train", False, 99.0, 9.0), (D(2020, 1, 3), "test", True, test_value, 7.0), (D(2020, 1, 1), "train", True, None, 5.0)]
        return normalize.train_stats(spark.createDataFrame(rows, "date date, split string, is_ocean boolean, sst double, sss double"), ["sst", "sss"]).first()

    a = stats(4.0)
    assert a == stats(1e9) and (a.sst_mean, a.sst_std, a.sss_std) == (2.0, 1.0, 1.0)


def test_normalize_land_and_missing_are_zero(spark):
    df = spark.createDataFrame([(1, True, 4.0), (2, False, 4.0), (3, True, None)], "k int, is_ocean boolean, sst double")
    st = spark.createDataFrame([(2.0, 2.0)], "sst_mean double, sst_std double")
    n = normalize.normalize(df, st, ["sst"])
    assert {r.k: r.sst for r in n.collect()} == {1: 1.0, 2: 0.0, 3: 0.0}
    assert {r.k: r.sst for r in normalize.denormalize(n, st, ["sst"]).collect()}[1] == 4.0
    assert qa.integrity(n, ["sst"]).first().passed


@pytest.mark.parametrize("n,want", [(1, (1, 0, 0)), (2, (2, 0, 0)), (3, (2, 1, 0)), (5, (4, 1, 0)), (10, (7, 2, 1)), (15, (10, 2, 3))])
def test_ratio_split(spark, n, want):
    rows = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(i),) for i in range(n)], "date date")
    got = {r.split: r["count"] for r in split.split_dates(rows).groupBy("split").count().collect()}
    # The same arithmetic as plain numbers, rounding half to even.
    if n >= 3:
        a, b = max(1, round(n * 0.7)), max(1, round(n * 0.15)) if n >= 5 else 1
        if n - a - b <= 0 and a > 1:
            a -= 1
        want = (a, min(b, n - a), max(0, n - a - b))
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == want


def test_nan_becomes_null_and_names(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, 3.0)], "Latitude double, thetao double")
    out = ingest.rename_variables(ingest.nan_to_null(ingest.normalize_names(df)))
    assert out.columns == ["lat", "sst"] and out.agg(F.avg("lat")).first()[0] == 2.0
    with pytest.raises(ValueError, match="missing channels: sss"):
        ingest.canonical_channels(out, ["lat"])


def test_flag_mask(spark):
    df = spark.createDataFrame([(1, 1.0), (9, 2.0), (2, 3.0), (None, 4.0)], "mask int, sst double")
    assert [(r.sst, r.is_ocean) for r in mask.mask_value(df, "sst").collect()] == [(1.0, 1), (None, 0), (None, 0), (None, 0)]


def test_fill_gaps(spark):
    vals = [None, 1.0, None, 3.0, None, None, None, 11.0, None]
    df = spark.createDataFrame([(1, D(2020, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(vals)], "k int, date date, v double")
    get = lambda **x: [r.v for r in align.fill_gaps(df, ["k"], "v", **x).orderBy("date").collect()]
    assert get() == [None, 1.0, 2.0, 3.0, 5.0, 7.0, 9.0, 11.0, None]
    assert get(max_days=1) == [None, 1.0, 2.0, 3.0, None, None, None, 11.0, None]
    assert get(method="forward", max_days=1) == [None, 1.0, 1.0, 3.0, 3.0, None, None, 11.0, 11.0]


def test_daily_mean_hours_and_dense(spark):
    t = dt.datetime
    df = spark.createDataFrame([(t(2020, 1, 1, 0), 1, 2.0), (t(2020, 1, 1, 6), 1, None), (t(2020, 1, 1, 7), 1, 100.0), (t(2020, 1, 3, 18), 1, 4.0)], "time timestamp, k int, v double")
    got = align.daily_mean(df, ["k"], ["v"], dense=True).orderBy("date").collect()
    assert [(r.date.day, r.v) for r in got] == [(1, 2.0), (2, None), (3, 4.0)]


def test_first_file_keeps_a_whole_slice(spark):
    df = spark.createDataFrame([(1, "b", 10), (1, "a", 11), (1, "a", 12), (2, "b", 13)], "time int, source_file string, cell int")
    assert sorted(r.cell for r in align.first_file_per_time(df).collect()) == [11, 12, 13]


def test_merge_first_source_wins_and_preference(spark):
    a = spark.createDataFrame([(D(2020, 1, 1), 0, 0, 1.0)], "date date, lat_idx int, lon_idx int, sst double")
    b = spark.createDataFrame([(D(2020, 1, 1), 0, 0, 2.0, 3.0), (D(2020, 1, 2), 0, 0, 2.0, 3.0)], "date date, lat_idx int, lon_idx int, sst double, sss double")
    assert [tuple(r)[3:] for r in merge.merge_sources([a, b]).collect()] == [(1.0, 3.0)]
    other = b.drop("sss")
    assert merge.prefer_source(a, other, 1).count() == 1 and merge.prefer_source(a, other, 2).count() == 2


def test_tensor_positions_and_verifier(spark):
    g = Grid(ny=2, nx=3)
    rows = [(D(2020, 1, 1), "train", i, j, float(10 * i + j), float(100 + 10 * i + j)) for i in range(2) for j in range(3) if (i, j) != (1, 1)]
    x = tensor.input_tensor(spark.createDataFrame(rows, "date date, split string, lat_idx int, lon_idx int, a double, b double"), ["split", "date"], ["a", "b"], g)
    assert x.first().inputs == [0, 1, 2, 10, 0, 12, 100, 101, 102, 110, 0, 112]
    t = spark.createDataFrame([(D(2020, 1, 1), "train", d, i, j, float(d * 100 + i * 10 + j)) for d in range(2) for i in range(2) for j in range(3)], "date date, split string, depth_idx int, lat_idx int, lon_idx int, temp double")
    y = tensor.target_tensor(t, ["split", "date"], 2, g)
    assert y.first().targets == [0, 1, 2, 10, 11, 12, 100, 101, 102, 110, 111, 112]
    assert tensor.verify(x.join(y, ["split", "date"]), 12, 12).first().ok
    assert not tensor.verify(x.join(y, ["split", "date"]), 13, 12).first().ok


def test_inversions_by_regime(spark):
    rows = [(0, 0, 10.0), (1, 5, 15.2), (2, 10, 10.0), (12, 500, 5.0), (13, 700, 6.05), (14, 1000, 6.0)]
    t = spark.createDataFrame([(D(2020, 1, 1), i, z, 0, 0, v) for i, z, v in rows], "date date, depth_idx int, depth_m int, lat_idx int, lon_idx int, temp double")
    m = spark.createDataFrame([(0, 0, True)], "lat_idx int, lon_idx int, is_ocean boolean")
    r = qa.inversions(t, m).first()
    assert (r.pairs, r.inversions, r.anomalies, r.passed) == (4, 2, 2, False)


def test_continuity(spark):
    days = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(i),) for i in range(365)], "date date")
    r = qa.continuity(days, ["2020-02-29"]).first()
    assert r.passed and r.calendar_days == 365
    assert not qa.continuity(days, ["2020-12-31"]).first().passed
    assert not qa.continuity(days.where("date <> '2020-03-01'")).first().passed
    assert [r.date for r in qa.missing_days(days.where("date <> '2020-03-01'")).collect()] == [D(2020, 3, 1)]


def test_skill_against_numpy(spark):
    rng = np.random.default_rng(1)
    t = rng.normal(10, 3, 60)
    p = t + rng.normal(0.5, 1, 60)
    z = [0, 10, 20] * 20
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(z, t, p)] + [(0, None, 1.0), (10, 1.0, None)], "depth_m int, t double, p double")
    got = {r.depth_m: r for r in metrics.skill(df, "t", "p").collect()}
    for k in (None, 0, 10, 20):
        use = np.array([k is None or v == k for v in z])
        a, b = t[use], p[use]
        assert got[k].n == use.sum() and got[k].rmse == pytest.approx(np.sqrt(((b - a) ** 2).mean())) and got[k].bias == pytest.approx((b - a).mean())
        assert got[k].r2 == pytest.approx(1 - ((b - a) ** 2).sum() / ((a - a.mean()) ** 2).sum()) and got[k].corr == pytest.approx(np.corrcoef(a, b)[0, 1])


def test_synthetic_follows_the_decay_law(spark):
    dates = spark.createDataFrame([(D(2020, 1, i),) for i in range(1, 4)], "date date")
    for r in synthetic.target(dates, COARSE).groupBy("depth_m").agg(F.avg("temp").alias("t")).collect():
        assert r.t == pytest.approx(4 + 24 * math.exp(-r.depth_m / 500), abs=0.05)
    s = synthetic.surface(dates, COARSE).agg(F.min("sst"), F.max("sst"), F.count("*")).first()
    assert 20 <= s[0] < 20.1 and 32.9 < s[1] <= 33 and s[2] == 3 * 21 * 49


def test_months_and_resume(spark, tmp_path):
    path = str(tmp_path / "m")
    df = lambda v, days: spark.createDataFrame([(d, 0, 0, v) for d in days], "date date, lat_idx int, lon_idx int, v int")
    sinks.write_months(df(1, [D(2020, 1, 1), D(2020, 2, 1)]), path)
    sinks.write_months(df(2, [D(2020, 2, 2)]), path)
    back = sinks.read_months(spark, path)
    assert sorted((r.date, r.v) for r in back.collect()) == [(D(2020, 1, 1), 1), (D(2020, 2, 2), 2)]
    todo = sinks.missing_months(sinks.months_between(spark, "2019-12", "2020-03"), back)
    assert sorted((r.year, r.month) for r in todo.collect()) == [(2019, 12), (2020, 3)]
    with pytest.raises(ValueError):
        sinks.months_between(spark, "2020-02", "2020-01")


def test_crops(spark):
    df = spark.createDataFrame([(4.0, 45.0), (5.0, 45.0), (30.0, 105.0), (31.0, 50.0)], "lat double, lon double")
    assert crop.crop_box(df).count() == 2 and crop.crop_box(df, buffer=1.0).count() == 4


def test_stats_json_order(spark):
    st = spark.createDataFrame([("b", 1.0, 2.0), ("a", 3.0, 4.0)], "channel string, mean double, std double")
    assert sinks.stats_json(st, ["b", "a"]).first().value == '{"b":{"mean":1.0,"std":2.0},"a":{"mean":3.0,"std":4.0}}'
