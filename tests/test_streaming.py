import datetime as dt

from pyspark.sql import functions as F

from gridspark.sources.snapshots import MonthTable
from gridspark.streaming import daily

SCHEMA = "time timestamp, k int, v double"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_samples_are_dropped_after_the_watermark(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    t = dt.datetime

    def run():
        stream = daily.read_files(spark, src, spark.read.parquet(src).schema)
        daily.write_days(daily.daily_mean_stream(stream, ["k"], ["v"], delay="1 day"), out, ck).awaitTermination()
        return sorted((r.date.day, r.v, r.n) for r in spark.read.parquet(out).collect())

    write(spark, src, [(t(2020, 1, 1, 0), 1, 2.0), (t(2020, 1, 1, 12), 1, 4.0), (t(2020, 1, 5, 0), 1, 1.0)])
    assert run() == [(1, 3.0, 2)]
    write(spark, src, [(t(2020, 1, 1, 18), 1, 100.0), (t(2020, 1, 9, 0), 1, 1.0)])
    assert run() == [(1, 3.0, 2), (5, 1.0, 1)]


def test_catch_up_processes_new_files_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def run():
        stream = daily.read_files(spark, src, spark.read.parquet(src).schema)
        daily.catch_up(stream, lambda df: df.where("v > 0"), lambda df: df.write.mode("append").parquet(out), ck).awaitTermination()
        return spark.read.parquet(out).count()

    write(spark, src, [(dt.datetime(2020, 1, 1), 1, 2.0), (dt.datetime(2020, 1, 1), 1, -2.0)])
    assert run() == 1 and run() == 1
    write(spark, src, [(dt.datetime(2020, 1, 2), 1, 2.0)])
    assert run() == 2


def test_a_month_over_two_batches_is_whole(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    table = MonthTable(spark, out)

    def rows():
        return sorted((r.date.isoformat(), r.k, r.v) for r in table.read().collect())

    def run():
        stream = daily.read_files(spark, src, spark.read.parquet(src).schema, files_at_once=1)
        job = lambda df: df.select(F.to_date("time").alias("date"), "k", "v")
        daily.catch_up_table(stream, job, table, ["date", "k"], ck, "days").awaitTermination()
        return rows()

    t = dt.datetime
    write(spark, src, [(t(2020, 1, 1), 1, 2.0)])
    write(spark, src, [(t(2020, 1, 2), 1, 3.0), (t(2020, 2, 1), 1, 4.0)])
    assert run() == [("2020-01-01", 1, 2.0), ("2020-01-02", 1, 3.0), ("2020-02-01", 1, 4.0)]
    write(spark, src, [(t(2020, 1, 2), 1, 5.0), (t(2020, 1, 3), 2, 6.0)])
    want = [("2020-01-01", 1, 2.0), ("2020-01-02", 1, 5.0), ("2020-01-03", 2, 6.0), ("2020-02-01", 1, 4.0)]
    assert run() == want
    # A batch that is run again changes nothing.
    table.merge(spark.createDataFrame([(dt.date(2020, 1, 3), 2, 7.0)], "date date, k int, v double"), ["date", "k"], ("days", 0))
    assert rows() == want
