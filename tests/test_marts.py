"""Committed, year and bucketed marts; landed inputs of the live job."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from runtally import config as C
from runtally import registry
from runtally.plans import canonical, jobs, live
from runtally.plans.context import RunTables
from runtally.sources import feeds, fixtures, marts, river, shared

CFG = C.FIXTURE_CONFIG


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    p = df._jdf.queryExecution().executedPlan().toString()
    return p.split("== Initial Plan ==")[-1] if "Initial Plan" in p else p


def versions(root, name):
    return sorted(p.name for p in (root / name).iterdir() if p.name.startswith("version="))


# ------------------------------------------------------------ commit


def test_failed_write_leaves_the_old_mart(spark, tmp_path):
    root = str(tmp_path)
    good = spark.range(100).selectExpr("id", "id % 3 AS species")
    marts.write_mart(good, root, "daily")
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"),
                                               (F.col("id") % 3).alias("species"))
    for write in (lambda: marts.write_mart(broken, root, "daily"), lambda: marts.write_years(broken, root, "daily", "species"),
                  lambda: marts.write_by_key(broken, root, "daily", "id", 4)):
        with pytest.raises(Exception, match="lost"):
            write()
        assert rows(marts.read_mart(spark, root, "daily").select("id", "species")) == rows(good)
        assert len(versions(tmp_path, "daily")) == 1


def test_driver_lost_before_the_pointer_moves(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    marts.write_mart(spark.range(5), root, "individuals")
    with monkeypatch.context() as m:
        m.setattr(shared, "replace_json", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            marts.write_mart(spark.range(9), root, "individuals")
    assert marts.read_mart(spark, root, "individuals").count() == 5
    marts.write_mart(spark.range(7), root, "individuals")
    assert marts.read_mart(spark, root, "individuals").count() == 7


def test_open_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path)
    marts.write_mart(spark.range(5), root, "individuals")
    before = marts.read_mart(spark, root, "individuals")
    marts.write_mart(before.selectExpr("id + 1 AS id"), root, "individuals")  # a mart may be rewritten from itself
    assert rows(before) == [(k,) for k in range(5)]
    assert rows(marts.read_mart(spark, root, "individuals")) == [(k,) for k in range(1, 6)]
    for _ in range(3):
        marts.write_mart(spark.range(2), root, "individuals")
    assert len(versions(tmp_path, "individuals")) == 2


def test_empty_datasets(spark, tmp_path):
    root, none = str(tmp_path), spark.range(0).selectExpr("id", "'x' AS species", "1 AS year")
    marts.write_mart(none, root, "daily")
    marts.write_years(none, root, "detections", "year")
    for name in ("daily", "detections"):
        df = marts.read_mart(spark, root, name)
        assert df.count() == 0 and sorted(df.dtypes) == sorted(none.dtypes)


def test_no_mart(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        marts.read_mart(spark, str(tmp_path), "daily")


# ------------------------------------------------------------ by year


def test_a_run_replaces_its_years_only(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, 1999, "a"), (2, 2000, "b"), (3, None, "c")], "k int, year int, s string")
    marts.write_years(first, root, "detections", "year")
    marts.write_years(spark.createDataFrame([(4, 2000, "d"), (5, 2001, "e")], "k int, year int, s string"), root, "detections", "year")
    got = marts.read_mart(spark, root, "detections")
    assert sorted(got.columns) == ["k", "s", "year"]
    assert rows(got.select("k", "year", "s")) == sorted([(1, 1999, "a"), (3, None, "c"), (4, 2000, "d"), (5, 2001, "e")], key=str)
    assert marts.partition_values(spark, root, "detections") == ["1999", "2000", "2001"]
    marts.write_years(first, root, "detections", "year")
    assert rows(marts.read_mart(spark, root, "detections").select("k")) == [(1,), (2,), (3,), (5,)]


def test_current_year_filter_prunes_year_partitions(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    root = str(tmp_path)
    jobs.land_detections(jobs.LiveFeeds(t.live_raw, t.live_downstream_raw, t.flow_daily), root)
    det = marts.read_mart(spark, root, "detections")
    cur = canonical.current_year_detections(det, CFG)
    p = plan(cur)
    scan = [x for x in p.splitlines() if "FileScan" in x][0]
    assert re.search(r"PartitionFilters: \[[^\]]*observation_year[^\]]*\]", scan), scan
    assert rows(cur.select(*sorted(cur.columns))) == rows(t.current_detections.select(*sorted(t.current_detections.columns)))
    # only the years that can hold current rows are opened
    files = {re.search(r"observation_year=(\w+)", r[0])[1] for r in cur.select(F.col("_metadata.file_path")).distinct().collect()}
    assert files <= {"2000", "2001"}


# ------------------------------------------------------------ by fish


def test_fish_level_aggregate_and_join_need_no_exchange(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    root = str(tmp_path)
    fd = jobs.LiveFeeds(t.live_raw, t.live_downstream_raw, t.flow_daily)
    jobs.land_detections(fd, root)
    det, ds = jobs.fish_level(spark, fd, root, CFG)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ind = live.individuals_live(det, ds, CFG)
        p = plan(ind)
        assert "SortMergeJoin" in p and "Exchange" not in p, p
        assert p.count("Bucketed: true") == 2
        juv = live.migratory_juveniles_live(det, ds)
        assert "SortMergeJoin" in plan(juv) and "Exchange" not in plan(juv)
        marks = ind.select("pit_id", "sfc_first").join(live.mark_attributes(det), "pit_id", "left")
        assert "Exchange" not in plan(marks)
        cols = [F.round(c, 6).alias(c) if c == "length_mm" else F.col(c) for c in live.INDIVIDUAL_COLUMNS]
        assert rows(ind.select(*cols)) == rows(t.individuals.select(*cols))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_is_not_bucketed(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("pit_id"), "id")
    marts.write_by_key(df, str(tmp_path), "a", "pit_id", 4, key_rows=300)
    marts.write_by_key(df, str(tmp_path), "b", "pit_id", 4, key_rows=400)
    a, b = (marts.read_mart(spark, str(tmp_path), n) for n in "ab")
    assert rows(a) == rows(b) == rows(df)
    assert "Exchange" in plan(a.groupBy("pit_id").count()) and "Exchange" not in plan(b.groupBy("pit_id").count())
    nulls = spark.createDataFrame([(None, 1), ("x", 2)], "pit_id string, id long")
    marts.write_by_key(nulls, str(tmp_path), "c", "pit_id", 3)
    assert rows(marts.read_mart(spark, str(tmp_path), "c")) == rows(nulls)
    marts.write_by_key(nulls.limit(0), str(tmp_path), "c", "pit_id", 3)
    assert marts.read_mart(spark, str(tmp_path), "c").count() == 0


# ------------------------------------------------------------ landed inputs


def test_report_of_several_files_is_one_scan_in_path_order(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    paths = feeds.land_report(t.completed_downstream_raw, str(tmp_path / "a b"), "completed_downstream", 6)
    order = [paths[k] for k in (3, 0, 5, 1, 4, 2)]
    raw = feeds.read_report(spark, order, "completed_downstream")
    assert plan(raw).count("FileScan csv") == 1
    want = [r.tag for p in order for r in feeds.read_report(spark, p, "completed_downstream").orderBy("ordinal").collect()]
    assert [r.tag for r in raw.orderBy("ordinal").collect()] == want and len(want) == t.completed_downstream_raw.count()
    # folders and globs, in the caller's order
    again = feeds.read_report(spark, [str(tmp_path / "a b" / "part-00001*"), str(tmp_path / "a b")], "completed_downstream")
    assert {r[0] for r in again.select("ordinal.file_rank").distinct().collect()} == {0, 1}


def test_large_report_file_is_landed_in_parts_and_read_in_order(spark, sf_dir, tmp_path):
    raw = RunTables.from_driver_tables(spark, sf_dir, CFG).live_downstream_raw
    utf16 = {"encoding": "UTF-16LE", "line_sep": "\r\n"}
    n, folder = raw.count(), tmp_path / "parts"
    paths = feeds.land_report(raw, str(folder), "live_downstream", 2, **utf16, part_rows=-(-n // 24))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["file=00000", "file=00001"]
    parts = [[sum(1 for _ in open(f, encoding="utf-16-le")) - 1 for f in sorted(folder.glob(f"file=0000{k}/part-*"))] for k in (0, 1)]
    assert [len(p) for p in parts] == [12, 12] and sum(map(sum, parts)) == n
    assert max(map(max, parts)) < n // 8  # no task writes a file's rows alone
    want = [(r.tag, r.site, r.obs_time) for r in raw.orderBy("ordinal").collect()]
    read = feeds.read_report(spark, paths, "live_downstream", **utf16)
    got = read.orderBy("ordinal").select("tag", "site", "obs_time", "ordinal.file_rank").collect()
    assert [tuple(r)[:3] for r in got] == want
    assert [r[3] for r in got] == sorted(r[3] for r in got) and {r[3] for r in got} == {0, 1}
    # the folder of all of them, and the caller's own order
    whole = feeds.read_report(spark, str(folder), "live_downstream", **utf16).orderBy("ordinal").select("tag", "site", "obs_time")
    assert list(map(tuple, whole.collect())) == want
    back = feeds.read_report(spark, paths[::-1], "live_downstream", **utf16).orderBy("ordinal").select("tag", "site", "obs_time")
    first = sum(parts[0])
    assert list(map(tuple, back.collect())) == want[first:] + want[:first]


def test_six_file_scan_of_large_files_lands_parts_and_keeps_the_rows(spark, sf_dir, monkeypatch):
    t, landed, land = RunTables.from_driver_tables(spark, sf_dir, CFG), [], feeds.land_report
    monkeypatch.setattr(feeds, "PART_ROWS", -(-t.completed_downstream_raw.count() // 18))
    monkeypatch.setattr(feeds, "land_report", lambda *a, **k: landed.extend(land(*a, **k)) or landed)
    got = registry.QUERIES["report_scan_six_files"](spark, sf_dir)
    assert rows(got) == rows(canonical.latest_downstream(t.downstream).select(*got.columns))
    assert [p.rsplit("/", 1)[1] for p in landed] == [f"file=0000{k}" for k in range(6)]
    # a part is written by one task: none has a file's rows
    assert all(len(shared.list_files(spark, p)) == 3 for p in landed)


def test_live_job_reads_landed_reports_and_river_files(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    utf16 = {"encoding": "UTF-16LE", "line_sep": "\r\n"}
    land = lambda df, name, feed, n, **how: feeds.land_report(df, str(tmp_path / name), feed, n, **how)
    live_det = land(t.live_raw, "det", "live_detections", 3, **utf16)
    live_ds = land(t.live_downstream_raw, "ds", "live_downstream", 2, **utf16)
    done_det = land(t.completed_raw, "cdet", "completed_detections", 1)
    done_ds = land(t.completed_downstream_raw, "cds", "completed_downstream", 6)
    long = str(tmp_path / "river_long")
    values = fixtures.river_daily_long(spark, sf_dir)
    values.withColumn("site_no", F.lit("g")).unionByName(values.withColumn("site_no", F.lit("other")).withColumn("value", F.col("value") * 9)).write.parquet(long)
    wide = str(tmp_path / "river_wide")
    t.flow_daily.select(F.col("date").cast("timestamp").alias("Date"), *[F.col(v).alias(k) for k, v in river.WIDE_COLUMNS.items()]).write.parquet(wide)
    got = {}
    for kind, at in (("long", dict(river=long, river_site="g")), ("wide", dict(river=wide, river_is_wide=True))):
        root = str(tmp_path / f"marts_{kind}")
        jobs.completed_years_job(jobs.completed_feeds(spark, jobs.LandedReports(done_det, done_ds)), root, CFG)
        jobs.live_job(spark, jobs.live_feeds(spark, jobs.LandedReports(live_det, live_ds, **at, **utf16), CFG), root, CFG)
        got[kind] = {m: rows(marts.read_mart(spark, root, m)) for m in ("sfc_flow", "run_stats", "daily")}
    assert got["long"] == got["wide"]
    assert got["long"]["sfc_flow"] == rows(t.flow) and t.flow.count() > 0
    stats = [c for c in t.run_stats.columns if c != "species"] + ["species"]  # the partition column is read last
    assert got["long"]["run_stats"] == rows(t.run_stats.select(*stats))
    assert max(r[0] for r in got["long"]["sfc_flow"]) <= CFG.as_of and isinstance(got["long"]["sfc_flow"][0][0], dt.date)


def test_scheduled_dashboard_dates_follow_the_host_zone(spark, sf_dir, tmp_path):
    host = C.FIXTURE_CONFIG_HOST_ZONE
    t = RunTables.from_driver_tables(spark, sf_dir, host)
    root = str(tmp_path)
    jobs.completed_years_job(jobs.CompletedFeeds(t.completed_raw, t.completed_downstream_raw), root, host)
    jobs.live_job(spark, jobs.LiveFeeds(t.live_raw, t.live_downstream_raw, t.flow_daily), root, host)
    d = jobs.dashboard_marts(spark, root, host)
    utc = t.individuals.select(F.to_date(F.convert_timezone(F.lit("America/Los_Angeles"), F.lit("UTC"), F.col("sfc_entry_final"))).alias("d"), "species")
    assert d.first_entry_date.first()[0] == utc.agg(F.min("d")).first()[0]
    recent = utc.filter(F.col("d") >= F.date_sub(F.lit(host.as_of), 7)).groupBy("species").count()
    assert rows(d.new_last_week) == rows(recent)
