"""Stores and merges for long axes, large grids and many months, against plain versions and brute force."""

import datetime as dt
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.functions.grid import Grid
from gridspark.operators import align, asof, chunks, coverage, moments, qa, regrid, tiled
from gridspark.plans import jobs
from gridspark.sources import bucketed, clustered
from gridspark.sources.snapshots import Conflict, MonthTable

T, D = dt.datetime, dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# -- as-of


@pytest.mark.parametrize("width", [asof.DAY, 3_600_000_000, 400 * asof.DAY])
def test_nearest_times_equal_brute_force(spark, width):
    rng = random.Random(width)
    start = T(1999, 12, 20)
    axis = sorted({start + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 60)) for _ in range(80)})
    times = [start + dt.timedelta(minutes=rng.randrange(-60 * 24 * 30, 60 * 24 * 120)) for _ in range(300)]
    times += [a + (b - a) / 2 for a, b in zip(axis, axis[1:])] + axis[:5] + [None]
    got = {r.juld: r.at for r in asof.nearest_times(spark.createDataFrame([(t, 1) for t in times * 2], "juld timestamp, at int"), spark.createDataFrame([(a,) for a in [*axis, None, axis[0]]], "at timestamp"), width=width).collect()}
    want = {t: min(axis, key=lambda a: (abs(a - t), -a.timestamp())) for t in times if t}
    assert got == want


def test_nearest_times_defined_cases(spark):
    none = spark.createDataFrame([], "at date")
    times = spark.createDataFrame([(T(2000, 1, 1, 13),)], "juld timestamp")
    assert [tuple(r) for r in asof.nearest_times(times, none).collect()] == [(T(2000, 1, 1, 13), None)]
    assert asof.nearest_times(times.where("false"), none).count() == 0
    days = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2000, 1, 2),)], "at date")
    assert asof.nearest_times(times, days).first().at == dt.date(2000, 1, 2)
    assert "collect_list" not in plan_of(asof.nearest_times(times, days))


# -- snapshots

ROWS = "date date, k int, v double"


def frame(spark, rows):
    return spark.createDataFrame([(dt.date(*d), k, v) for d, k, v in rows], ROWS)


def stored(table, version=None):
    return sorted(((r.date.isoformat(), r.k, r.v) for r in table.read(version).collect()), key=str)


def test_a_job_that_ends_before_its_commit_leaves_the_old_months(spark, tmp_path, monkeypatch):
    table = MonthTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, [((2020, 1, 1), 1, 1.0), ((2020, 2, 1), 1, 2.0)]))
    before = stored(table)

    def killed(self, manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(MonthTable, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            table.replace(frame(spark, [((2020, 1, 5), 9, 9.0)]))
    assert stored(MonthTable(spark, str(tmp_path / "t"))) == before
    # The files that it left are not the table's, and go.
    assert table.vacuum() == 1 and stored(table) == before
    assert table.replace(frame(spark, [((2020, 1, 5), 9, 9.0)])) == 2
    assert stored(table) == [("2020-01-05", 9, 9.0), ("2020-02-01", 1, 2.0)] and stored(table, 1) == before
    assert table.vacuum() == 1 and table.versions() == [2] and len(stored(table)) == 2


def test_of_two_writers_one_starts_again(spark, tmp_path, monkeypatch):
    a, b = MonthTable(spark, str(tmp_path / "t")), MonthTable(spark, str(tmp_path / "t"))
    a.replace(frame(spark, [((2020, 1, 1), 1, 1.0)]))
    commit, beaten = MonthTable._commit, []

    def second(self, manifest):
        if not beaten:
            beaten.append(1)
            b.merge(frame(spark, [((2020, 1, 2), 2, 2.0)]), ["date", "k"])
        commit(self, manifest)

    monkeypatch.setattr(MonthTable, "_commit", second)
    assert a.merge(frame(spark, [((2020, 1, 3), 3, 3.0)]), ["date", "k"]) == 3
    assert [r[1] for r in stored(a)] == [1, 2, 3]
    with pytest.raises(Conflict):
        commit(a, a.manifest() | {"version": 3})


def test_merge_replaces_equal_keys_once(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"))
    table.merge(frame(spark, [((2020, 1, 1), 1, 1.0), ((2020, 1, 1), None, 2.0), ((2020, 1, 2), 1, 3.0)]), ["date", "k"], ("s", 0))
    again = frame(spark, [((2020, 1, 1), None, 5.0), ((2020, 1, 1), None, 4.0), ((2020, 1, 9), 1, 6.0)])
    version = table.merge(again, ["date", "k"], ("s", 1))
    want = [("2020-01-01", 1, 1.0), ("2020-01-01", None, 5.0), ("2020-01-02", 1, 3.0), ("2020-01-09", 1, 6.0)]
    assert stored(table) == want
    # The batch comes again, and an older one does.
    assert table.merge(again.withColumn("v", F.lit(0.0)), ["date", "k"], ("s", 1)) == version == table.merge(again, ["date", "k"], ("s", 0))
    assert stored(table) == want
    # Another stream's batch of that number counts on its own.
    assert table.merge(frame(spark, []), ["date", "k"], ("other", 1)) == version + 1
    assert stored(table) == want


def test_only_listed_months_are_read_and_missing_ones_known(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.replace(frame(spark, [((2020, m, 1), m, float(m)) for m in range(1, 13)]))
    some = table.read(months=[(2020, 3), (2021, 1)])
    assert [r.k for r in some.collect()] == [3] and len(some.inputFiles()) == 1
    wanted = spark.createDataFrame([(2020, 5), (2021, 1)], "year int, month int")
    assert [tuple(r) for r in table.missing(wanted).collect()] == [(2021, 1)]
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([(None, 1, 1.0)], ROWS))


# -- tiles


@pytest.mark.parametrize(("tile", "down"), [(3, False), (4, True), (256, False)])
def test_tiles_equal_the_plain_regrid(spark, tile, down):
    rng = random.Random(tile)
    lat, lon = [2.0 * i for i in range(9)], [1.5 * i for i in range(12)]
    if down:
        lat = lat[::-1]
    grid = Grid(lat0=-1.0, lon0=-1.0, step=0.5, ny=40, nx=41)
    dst_lat, dst_lon = [-1.0 + 0.5 * i for i in range(40)], [-1.0 + 0.5 * i for i in range(41)]
    rows = [(dt.date(2020, 1, d), i, j, rng.choice([None, rng.random(), rng.random(), rng.random(), rng.random()]), rng.random()) for d in (1, 2) for i in range(9) for j in range(12) if rng.random() < 0.95]
    native = spark.createDataFrame(rows, "date date, src_lat_idx int, src_lon_idx int, a double, b double")
    src = [spark.createDataFrame(list(enumerate(x)), "idx int, coord double") for x in (lat, lon)]
    weights = [regrid.axis_weights(s, d) for s, d in zip(src, grid.axes(spark))]
    of = lambda df: {(r.date, r.lat_idx, r.lon_idx): tuple(None if x is None else round(x, 9) for x in (r.a, r.b)) for r in df.collect() if r.a is not None or r.b is not None}
    want = of(regrid.regrid(native, ["a", "b"], *weights))
    out = tiled.regrid_tiled(native, ["a", "b"], lat, lon, dst_lat, dst_lon, tile=tile)
    assert of(out) == want and len(want) > 500
    assert out.groupBy("date", "lat_idx", "lon_idx").count().where("count > 1").count() == 0
    # One exchange, by day and tile.
    assert plan_of(out).count("Exchange hashpartitioning(date") == 1 and plan_of(out).count("Exchange") == 1


def test_nodes_that_no_cell_needs_are_not_dealt(spark):
    lat = tiled.Axis([k / 10 - 90 for k in range(1801)], [5.0 + 0.25 * i for i in range(101)])
    assert lat.used() == (950, 1201)
    nodes = spark.range(1801).selectExpr("date'2020-01-01' as date", "int(id) as src_lat_idx", "2300 as src_lon_idx", "1d as v")
    lon = tiled.Axis([k / 10 - 180 for k in range(3600)], [45.0 + 0.25 * i for i in range(241)])
    assert tiled.dealt(nodes, lat, lon, 256).select("src_lat_idx").distinct().count() == 252
    none = tiled.regrid_tiled(nodes.where("false"), ["v"], [0.0, 1.0], [0.0, 1.0], [0.5], [0.5])
    assert none.count() == 0


# -- gaps


@pytest.mark.parametrize(("method", "most"), [("linear", None), ("linear", 40), ("forward", None), ("forward", 50)])
def test_gaps_by_month_equal_whole_windows(spark, method, most):
    rng = random.Random(len(method))
    days = [dt.date(2019, 11, 20) + dt.timedelta(n) for n in range(200)]
    rows = [(k, d, rng.random() if rng.random() < (0.02 if k == 1 else 0.3) else None) for k in (0, 1, 2, None) for d in days]
    rows += [(5, d, None) for d in days[:40]]
    df = spark.createDataFrame(rows, "k int, date date, v double")
    of = lambda out: sorted(((r.k, r.date, None if r.v is None else round(r.v, 9)) for r in out.collect()), key=str)
    got = align.fill_gaps_by_month(df, ["k"], "v", method=method, max_days=most)
    assert of(got) == of(align.fill_gaps(df, ["k"], "v", method=method, max_days=most))
    windows = [line for line in plan_of(got).split("\n") if "windowspecdefinition" in line]
    # Windows by cell alone run over the months' summaries only: they don't see the value.
    assert windows and all("__month" in line for line in windows)


# -- stored joins


def test_bucketed_tables_join_in_place(spark):
    cells = spark.range(5000).selectExpr("date_add(date'2020-01-01', int(id % 20)) as date", "int(id % 101) as lat_idx", "int(id % 241) as lon_idx", "id as a")
    x, y = bucketed.write_bucketed(cells, buckets=4), bucketed.write_bucketed(cells.withColumnRenamed("a", "b"), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table(x).join(spark.table(y), bucketed.CELL)
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert joined.where("a = b").count() == cells.join(cells.withColumnRenamed("a", "b"), bucketed.CELL).where("a = b").count()
        # The small side is dealt as the stored one lies.
        wanted = cells.where("a < 50").drop("a").hint("merge")
        one = spark.table(x).join(wanted, bucketed.CELL)
        assert plan_of(one).count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_stored_target_is_not_moved(spark):
    from gridspark.operators import collocate

    profiles = spark.createDataFrame([(1, "f", T(2020, 1, 1, 13), 10.1, 60.1), (2, None, T(2020, 1, 5, 1), 12.0, 70.0)], "profile_idx long, float_id string, juld timestamp, lat double, lon double")
    levels = spark.createDataFrame([(p, z, 20.0 - z / 100) for p in (1, 2) for z in (0.0, 50.0, 200.0)], "profile_idx long, pres double, temp double")
    grid = Grid(step=1.25, ny=21, nx=49)
    target = spark.range(15 * 6).selectExpr("date_add(date'2020-01-01', int(id div 15)) as date", "4 as lat_idx", "12 as lon_idx", "int(id % 15) as depth_idx", "double(id) as temp")
    plain = collocate.collocate(profiles, levels, target, grid)
    name = bucketed.write_bucketed(target, buckets=4)
    out = collocate.collocate(profiles, levels, spark.table(name), grid, mode="long", stored=True)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    lines = plan_of(out).split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and name in line)
    depth = lines[scan].index("FileScan")
    above = []
    for line in lines[scan::-1]:
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if at < depth:
            above.append(line.strip())
            depth = at
        if "SortMergeJoin" in line:
            break
    assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)


def many_profiles(spark, n=60):
    """Profiles in a few cells and on two days, each with its own time; one has none, one is outside. Levels, and a target that lacks depths and
    cells and has one row twice."""
    p = [(i, f"f{i % 7}", T(2020, 1, 1 + i % 2, i % 24, i % 60), 10.1 + 1.25 * (i % 3), 60.1) for i in range(n)] + [(n, None, None, 10.1, 60.1), (n + 1, "far", T(2020, 1, 1), 50.0, 60.0)]
    profiles = spark.createDataFrame(p, "profile_idx long, float_id string, juld timestamp, lat double, lon double")
    levels = spark.createDataFrame([(i, float(z), 20.0 - z / 100 - i / 1000) for i in range(0, n + 2, 2) for z in (0, 40, 40 + i, 600)], "profile_idx long, pres double, temp double")
    t = [(D(2020, 1, d), a, 12, k, 100.0 * d + 10 * a + k / 100) for d in (1, 2, 4) for a in (4, 5) for k in range(0, 15, 1 + a % 2)] + [(D(2020, 1, 2), 4, 12, 3, 7.5), (D(2020, 1, 2), 4, 12, 15, 8.5)]
    return profiles, levels, spark.createDataFrame(t, "date date, lat_idx int, lon_idx int, depth_idx int, temp double")


def by_hand(profiles, levels, target, grid):
    """Rows of the collocation by plain loops."""
    depths, out = [0, 5, 10, 20, 30, 50, 75, 100, 125, 150, 200, 300, 500, 700, 1000], []
    target, levels = target.collect(), levels.collect()
    axis = sorted({r.date for r in target})
    for p in profiles.collect():
        if not (5 <= p.lat <= 30 and 45 <= p.lon <= 105):
            continue
        i, j = math.ceil((p.lat - 5) / grid.step - 0.5), math.ceil((p.lon - 45) / grid.step - 0.5)
        day = p.juld and min(axis, key=lambda d: (abs(T(d.year, d.month, d.day) - p.juld), -d.toordinal()))
        known = {}
        for r in levels:
            if r.profile_idx == p.profile_idx:
                known.setdefault(r.pres, []).append(r.temp)
        z = sorted(known)
        for k, depth in enumerate(depths):
            temp = None
            if len(z) > 1 and z[0] <= depth <= z[-1]:
                temp = round(float(np.interp(depth, z, [sum(known[x]) / len(known[x]) for x in z])), 3)
            for g in [r.temp for r in target if (r.date, r.lat_idx, r.lon_idx, r.depth_idx) == (day, i, j, k)] or [None]:
                out.append((str(p.juld)[:10] if p.juld else None, p.float_id or f"profile_{p.profile_idx}", depth, temp, g))
    return sorted(map(str, out))


def found(out):
    return sorted(str((r.date, r.float_id, r.depth_m, None if r.argo_temp is None else round(r.argo_temp, 3), r.glorys_temp)) for r in out.collect())


@pytest.mark.parametrize("mode", ["nearest", "long"])
@pytest.mark.parametrize("bound", [0, 200_000])
def test_collocation_equals_plain_loops(spark, monkeypatch, mode, bound):
    from gridspark.operators import collocate

    monkeypatch.setattr(collocate, "WANTED_ROWS", bound)
    profiles, levels, target = many_profiles(spark)
    grid = Grid(step=1.25, ny=21, nx=49)
    assert found(collocate.collocate(profiles, levels, target, grid, mode=mode)) == by_hand(profiles, levels, target, grid)


def test_what_is_broadcast_counts_cells_and_not_profiles(spark, monkeypatch):
    """Sixty profiles in six cells and days are within a bound of six cells' depths."""
    from gridspark.operators import collocate

    monkeypatch.setattr(collocate, "WANTED_ROWS", 90)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    seen = []
    monkeypatch.setattr(collocate.F, "broadcast", lambda df, f=F.broadcast: seen.append(df.count()) or f(df))
    try:
        profiles, levels, target = many_profiles(spark, 160)
        out = collocate.collocate(profiles, levels, target, Grid(step=1.25, ny=21, nx=49))
        assert "BroadcastHashJoin" in plan_of(out) and seen and max(seen) <= 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_by_depth_are_never_broadcast(spark, monkeypatch, tmp_path):
    """Small files hold many profiles, and a row for each of their depths is far more than the files' size says; skill needs only rows with both values,
    so either side of an inner join could be sent."""
    from gridspark.operators import collocate, metrics

    monkeypatch.setattr(collocate, "WANTED_ROWS", 90)
    stored = []
    for k, df in enumerate(many_profiles(spark, 160)):
        df.write.parquet(f"{tmp_path}/{k}")
        stored.append(spark.read.parquet(f"{tmp_path}/{k}"))
    out = metrics.skill(collocate.collocate(*stored, Grid(step=1.25, ny=21, nx=49)), "argo_temp", "glorys_temp")
    lines = plan_of(out).split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            assert not any("Generate" in x or "profile_idx" in x for x in lines[i + 1 : below])


def exchanges(df):
    return [line for line in plan_of(df).split("\n") if " Exchange " in f" {line.lstrip(' :+-')}"]


def test_profiles_are_dealt_once_by_key_and_not_by_depth(spark, monkeypatch):
    from gridspark.operators import collocate

    monkeypatch.setattr(collocate, "WANTED_ROWS", 90)
    tables, grid = many_profiles(spark, 160), Grid(step=1.25, ny=21, nx=49)
    out = collocate.collocate(*tables, grid)
    by_key = [x for x in exchanges(out) if "hashpartitioning(profile_idx" in x]
    assert by_key and len(by_key) <= 4 and not any("depth_idx" in x for x in exchanges(out))
    assert found(out) == by_hand(*tables, grid)


def test_profiles_are_not_dealt_by_cell_to_a_stored_target(spark, monkeypatch):
    """Few cells and times of many profiles: the cells go to the stored target, and what is found there comes back."""
    from gridspark.operators import collocate

    monkeypatch.setattr(collocate, "WANTED_ROWS", 130)
    profiles, levels, target = many_profiles(spark, 160)
    grid = Grid(step=1.25, ny=21, nx=49)
    name = bucketed.write_bucketed(target, buckets=4)
    out = collocate.collocate(profiles, levels, spark.table(name), grid, mode="long", stored=True)
    dealt = exchanges(out)
    assert not any("juld" in x or "depth_idx" in x for x in dealt)
    by_cell = [i for i, x in enumerate(dealt) if "hashpartitioning(date" in x]
    assert len(by_cell) == 1 and len(dealt) <= 5
    assert found(out) == by_hand(profiles, levels, target, grid)


def test_compressed_csv_has_the_same_text(spark, tmp_path):
    from gridspark.sources import sinks

    df = spark.range(3000).selectExpr("string(id div 15) as float_id", "if(id % 7 = 0, null, round(id / 7, 4)) as temp", "int(id % 15) as depth_m").coalesce(2)
    for kind in ("none", "gzip"):
        sinks.write_csv(df, f"{tmp_path}/{kind}", kind)
    plain, packed = ([r.value for r in spark.read.text(f"{tmp_path}/{kind}").collect()] for kind in ("none", "gzip"))
    assert len(plain) == 3002 and sorted(plain) == sorted(packed)
    sinks.write_csv(df, f"{tmp_path}/default")
    assert all(f.endswith(".csv") for f in spark.read.text(f"{tmp_path}/default").inputFiles())


def test_the_grid_collocation_lies_compressed(spark):
    from gridspark.plans import registry

    out = registry.queries()["s8_collocation_csv_grid"](spark, "/root/testdata/sf0.001")
    files = out.inputFiles()
    n_bytes = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert n_bytes < 25 * out.agg(F.sum("n_rows")).first()[0]


# -- moments


def test_moments_of_parts_are_those_of_the_whole(spark, tmp_path):
    rng = random.Random(3)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(90)), rng.choice(["a", "b"]), rng.choice([None, float("nan"), 1e6 + rng.random(), 1e6 + rng.random()])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "date date, g string, v double")
    table = MonthTable(spark, str(tmp_path / "m"))
    moments.add_months(table, df.where("month(date) < 3"), ["v"], ["g"])
    moments.add_months(table, df.where("month(date) >= 3"), ["v"], ["g"])
    got = {r.g: r for r in moments.summary(moments.merged(table.read(), ["g"]), ["g"]).collect()}
    for g in "ab":
        x = np.array([v for _, k, v in rows if k == g and v is not None and not math.isnan(v)])
        assert (got[g].n, got[g].missing) == (len(x), sum(k == g for _, k, _ in rows) - len(x))
        assert got[g].mean == pytest.approx(x.mean(), rel=1e-12) and got[g].std == pytest.approx(x.std(), rel=1e-9)
        assert (got[g].min, got[g].max) == (x.min(), x.max())
    # A month that comes again is replaced, not counted twice; others keep their files.
    files = set(table.read(months=[(2020, 1)]).inputFiles())
    moments.add_months(table, df.where("month(date) = 3"), ["v"], ["g"])
    assert {r.g: r.n for r in moments.merged(table.read(), ["g"]).collect()} == {g: got[g].n for g in "ab"}
    assert set(table.read(months=[(2020, 1)]).inputFiles()) == files
    assert moments.stats_of(moments.merged(moments.day_moments(df.where("false"), ["v"])), ["v"]).first().asDict() == {"v_mean": None, "v_std": 1.0}


# -- observed checks


def test_observed_card_equals_the_checks(spark, tmp_path):
    from gridspark.functions.grid import CHANNELS
    from gridspark.operators import mask as masks
    from gridspark.operators import normalize, split

    rng = random.Random(8)
    grid = Grid()
    days = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(8)]
    cells = [(rng.randrange(101), rng.randrange(241)) for _ in range(40)]
    ocean = spark.createDataFrame([(a, b, rng.random() < 0.8) for a, b in set(cells)], "lat_idx int, lon_idx int, is_ocean boolean")
    surface = spark.createDataFrame([(d, a, b, *(rng.gauss(0, 0.3) for _ in CHANNELS)) for d in days for a, b in set(cells)], "date date, lat_idx int, lon_idx int, " + ", ".join(f"{c} double" for c in CHANNELS))
    for shift, extra in ((0.0, []), (30.0, [dt.date(2021, 1, 1)])):
        target = spark.createDataFrame([(d, k, m, a, b, 28.0 - m / 45 + shift * (k == 2)) for d in days + extra for a, b in set(cells) for k, m in enumerate((0, 100, 1000))], "date date, depth_idx int, depth_m int, lat_idx int, lon_idx int, temp double")
        rows = split.with_split(masks.with_mask(surface, ocean), split.split_dates(surface))
        filled = masks.with_mask(target, ocean).withColumn("temp", F.when(F.col("is_ocean"), F.col("temp")).otherwise(0.0))
        plain = jobs.audit(surface, target, ocean, normalize.normalize(rows, normalize.train_stats(rows)), filled, grid).first()
        card = jobs.write_audited(surface, target, ocean, str(tmp_path / f"out{shift}"), grid).first()
        assert card == plain and card.total_checks == 7
        one = {r.check: r.passed for df in (qa.surface_checks(surface, ocean, grid), qa.target_checks(target, ocean)) for r in df.collect()}
        each = {"salinity": qa.salinity_contrast(surface, ocean, grid), "winds": qa.wind_vector(surface, ocean), "currents": qa.current_bounds(surface, ocean), "stratification": qa.stratification(target, ocean), "inversions": qa.inversions(target, ocean)}
        assert one == {k: df.first().passed for k, df in each.items()}
        written = spark.read.parquet(str(tmp_path / f"out{shift}/target"))
        assert set(written.columns) == {*target.columns, "is_ocean"} and written.count() == target.count()


# -- chunks


def test_chunks_hold_the_arrays(spark):
    rng = random.Random(9)
    size, block = 50, 16
    cells = [(s, d, p, rng.choice([None, rng.random()]), rng.random()) for s, d in (("a", 1), ("a", 2), ("b", 1)) for p in rng.sample(range(size), 30)]
    df = spark.createDataFrame(cells, "split string, d int, p long, x double, y double")
    made = chunks.chunked(df, ["x", "y"], ["split", "d"], F.col("p"), size, block)
    got = {(r.split, r.d, r.position): (r.x, r.y) for r in chunks.cells(made, ["x", "y"], ["split", "d"], size, block).collect()}
    for s, d, p, x, y in cells:
        assert got[s, d, p] == (pytest.approx(x or 0, rel=1e-6), pytest.approx(y, rel=1e-6))
    assert sum(v != (0, 0) for v in got.values()) == len(cells)
    report = chunks.verify(made, 2, ["split", "d"], size, block).collect()
    assert len(report) == 3 and all(r.ok and r.n_cells == 30 and r.n_chunks == 4 for r in report)
    # Damage to one chunk, one that is there twice, and a NaN are found.
    hurt = made.withColumn("data", F.when((F.col("d") == 2) & (F.col("chunk") == 1), F.expr("cast(overlay(data placing X'FF' from 7) as binary)")).otherwise(F.col("data")))
    assert {(r.split, r.d): r.damaged for r in chunks.verify(hurt, 2, ["split", "d"], size, block).collect()} == {("a", 1): 0, ("a", 2): 1, ("b", 1): 0}
    twice = made.unionByName(made.where("split = 'b' and chunk = 0"))
    assert [r.ok for r in chunks.verify(twice, 2, ["split", "d"], size, block).orderBy("split", "d").collect()] == [True, True, False]
    bad = chunks.chunked(df.withColumn("y", F.expr("if(p = 3, double('nan'), y)")), ["x", "y"], ["split", "d"], F.col("p"), size, block)
    assert sum(r.damaged for r in chunks.verify(bad, 2, ["split", "d"], size, block).collect()) == sum(p == 3 for _, _, p, _, _ in cells)


def test_chunks_refuse_what_has_no_place(spark):
    df = spark.createDataFrame([(1, 3, 1.0), (1, 3, 2.0)], "d int, p int, x double")
    for rows in (df, df.limit(1).withColumn("p", F.lit(99))):
        with pytest.raises(Exception, match="two rows of one cell|outside"):
            chunks.chunked(rows, ["x"], ["d"], F.col("p"), 50).collect()
    assert chunks.chunked(df.where("false"), ["x"], ["d"], F.col("p"), 50).count() == 0


# -- coverage


def test_bitmaps_know_which_cells_lack(spark):
    rng = random.Random(10)
    cells = coverage.BITS + 500
    there = {d: set(rng.sample(range(cells), 2000)) | {0, cells - 1} for d in (1, 2)} | {3: {5}}
    df = spark.createDataFrame([(d, c) for d, s in there.items() for c in s for _ in range(1 + c % 2)], "d int, c long")
    maps = coverage.bitmaps(df, F.col("c"), ["d"])
    assert {r.d: r.n_cells for r in coverage.completeness(maps, cells, ["d"]).collect()} == {d: len(s) for d, s in there.items()}
    lack = {}
    for r in coverage.lacking(maps, cells, ["d"]).collect():
        lack.setdefault(r.d, set()).add(r.cell)
    assert lack == {d: set(range(cells)) - s for d, s in there.items()}
    both = coverage.combined(maps.withColumn("g", F.lit(1)), ["g"])
    assert coverage.completeness(both, cells, ["g"]).first().n_cells == len(set().union(*there.values()))


# -- clustered files


def test_a_section_opens_only_its_files(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(40_000).selectExpr("date_add(date'2020-01-01', int(id % 40)) as date", "int(id div 40 % 25) as lat_idx", "int(id div 1000) as lon_idx", "id as v")
    clustered.write_clustered(df.unionByName(spark.createDataFrame([(None, 1, 1, -1)], "date date, lat_idx int, lon_idx int, v long")), path, ["date", "lat_idx", "lon_idx"], 32)
    assert clustered.zones(spark, path).count() == 32
    day = dt.date(2020, 1, 20)
    for ranges, most in (({"date": (day, day), "lon_idx": (7, 7)}, 12), ({"lat_idx": (3, 4), "lon_idx": (7, 9)}, 14), ({"date": (day, day), "lat_idx": (3, 3), "lon_idx": (7, 7)}, 5)):
        found = clustered.read_range(spark, path, ranges)
        assert len(clustered.files_in(spark, path, ranges)) <= most
        inside = [F.col(c).between(F.lit(a), F.lit(b)) for c, (a, b) in ranges.items()]
        want = df
        for c in inside:
            want = want.where(c)
        assert sorted(r.v for r in found.collect()) == sorted(r.v for r in want.collect())
    assert clustered.read_range(spark, path, {"lat_idx": (99, 99)}).count() == 0
