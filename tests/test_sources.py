"""Lake layout (day-partitioned, pruned slices) and JDBC option building."""

import datetime as dt

from pyspark.sql import functions as F

from lastmile.sources import jdbc
from lastmile.sources.lake import read_raw, read_raw_slice, slice_filter, write_raw


def test_partitioned_lake_slice_prunes_days(make_raw, tmp_path):
    raw = make_raw(
        [
            {"order_id": i, "created_at": f"2000-01-{d:02d} 12:00:00"}
            for i, d in enumerate([1, 2, 3, 3, 4, 5], start=1)
        ]
    )
    path = str(tmp_path / "lake")
    write_raw(raw, path)
    sliced = read_raw_slice(raw.sparkSession, path, dt.datetime(2000, 1, 2, 12), "2000-01-04 00:00:00",
                            partitioned=True)
    assert sorted(r.order_id for r in sliced.collect()) == [2, 3, 4]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan
    full = read_raw(raw.sparkSession, path)
    assert full.count() == 6 and "created_date" not in full.drop("created_date").columns


def test_month_layout_slice(make_raw, tmp_path):
    raw = make_raw([{"order_id": i, "created_at": f"2000-{m:02d}-15 00:00:00"} for i, m in enumerate([1, 2, 2, 3], 1)])
    path = str(tmp_path / "monthly")
    write_raw(raw, path, granularity="month")
    sliced = read_raw_slice(raw.sparkSession, path, "2000-02-10", "2000-03-01", partitioned=True)
    assert sorted(r.order_id for r in sliced.collect()) == [2, 3]


def test_slices_equal_the_plain_filter_in_every_layout(make_raw, tmp_path):
    days = [(m, d) for m in (1, 2, 3) for d in (1, 9, 10, 11, 28)]
    raw = make_raw([{"order_id": i, "created_at": f"2000-{m:02d}-{d:02d} 12:00:00"} for i, (m, d) in enumerate(days)])
    spark = raw.sparkSession
    for layout in ("day", "month"):
        write_raw(raw, str(tmp_path / layout), granularity=layout)
    raw.write.parquet(str(tmp_path / "flat"))
    utc3 = dt.timezone(dt.timedelta(hours=3))
    bounds = [("2000-02-10", "2000-03-01"), ("2000-01-09 12:00:00", "2000-01-09 12:00:01"), ("2000-01-01", "2000-04-01"),
              (dt.datetime(2000, 2, 9, 15, tzinfo=utc3), dt.datetime(2000, 2, 10, 15, tzinfo=utc3)),
              ("2000-02-09T15:00:00+03:00", "2000-02-10T15:00:00+03:00")]
    for start, end in bounds:
        want = sorted(r.order_id for r in raw.filter(slice_filter(start, end)).collect())
        for layout in ("day", "month", "flat"):
            got = read_raw_slice(spark, str(tmp_path / layout), start, end, partitioned=layout != "flat")
            assert sorted(r.order_id for r in got.collect()) == want, (layout, start)
    aware = raw.filter(slice_filter(*bounds[3])).collect()
    assert [r.created_at for r in aware] == [dt.datetime(2000, 2, 9, 12)]  # 15:00 at +03:00


def test_unpartitioned_slice_pushes_range_filter(make_raw, tmp_path):
    raw = make_raw([{"order_id": 1, "created_at": "2000-01-01 00:00:00"}])
    path = str(tmp_path / "flat")
    raw.write.parquet(path)
    df = read_raw_slice(raw.sparkSession, path, "2000-01-01", "2000-01-02")
    assert df.count() == 1
    assert "GreaterThanOrEqual(created_at" in df._jdf.queryExecution().executedPlan().toString()
    assert df.filter(F.col("order_id") == 1).count() == 1


def test_jdbc_options():
    opts = jdbc.read_options("jdbc:x", "dwh.orders", {"user": "u"}, partition_column="order_id",
                             lower_bound=1, upper_bound=100, num_partitions=8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "order_id"
    assert opts["preferTimestampNTZ"] == "true"
    w = jdbc.write_options("jdbc:x", "mart.mart_orders", {}, truncate=True)
    assert w["batchsize"] == "5000" and w["truncate"] == "true" and w["cascadeTruncate"] == "true"
    assert "truncate" not in jdbc.write_options("jdbc:x", "t", {})
