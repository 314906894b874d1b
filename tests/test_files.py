"""Landed report files, river values, Parquet marts and batch jobs."""


import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from runtally import config as C
from runtally.plans import canonical, jobs
from runtally.plans.context import RunTables
from runtally.sources import feeds, fixtures, marts, river

CFG = C.FIXTURE_CONFIG


def _write_report(pdf: pd.DataFrame, headers: dict, path, bom: bool):
    out = pdf[list(headers.values())].copy()
    out.columns = list(headers)
    text = out.to_csv(index=False, lineterminator="\r\n")
    data = text.encode("utf-16-le")
    path.write_bytes((b"\xff\xfe" if bom else b"") + data)


def _live_pdf(spark, sf_dir):
    raw = fixtures.detection_feed(spark, sf_dir, CFG).orderBy("ordinal")
    return raw.drop("run_name").toPandas()


def _canon_key(df):
    return sorted((tuple(r) for r in df.drop("ordinal").collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_utf16_report_with_and_without_bom_many_splits(spark, sf_dir, tmp_path):
    pdf = _live_pdf(spark, sf_dir)
    for bom in (True, False):
        path = tmp_path / f"report_{bom}.csv"
        _write_report(pdf, feeds.LIVE_DETECTIONS, path, bom)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        try:
            raw = feeds.standardise(feeds.read_report(spark, str(path), "live_detections", "UTF-16LE", "\r\n"))
            assert raw.rdd.getNumPartitions() > 1
            got = canonical.canonical_detections(raw).cache()
            want = canonical.canonical_detections(fixtures.detection_feed(spark, sf_dir, CFG))
            assert got.count() == len(pdf)
            assert _canon_key(got) == _canon_key(want)
            # report order survives the splits: ordinal order == file order
            order = [r.pit_id for r in got.orderBy("ordinal").select("pit_id").collect()]
            assert order == list(pdf["tag"])
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_multi_file_union_keeps_file_order(spark, sf_dir, tmp_path):
    pdf = _live_pdf(spark, sf_dir)
    half = len(pdf) // 2
    p1, p2 = tmp_path / "b.csv", tmp_path / "a.csv"   # file order != name order
    _write_report(pdf.iloc[:half], feeds.LIVE_DETECTIONS, p1, True)
    _write_report(pdf.iloc[half:], feeds.LIVE_DETECTIONS, p2, True)
    raw = feeds.read_report(spark, [str(p1), str(p2)], "live_detections", "UTF-16LE", "\r\n")
    order = [r.tag for r in raw.orderBy("ordinal").select("tag").collect()]
    assert order == list(pdf["tag"])


def test_jobs_write_and_read_marts(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    root = str(tmp_path / "marts")
    jobs.completed_years_job(jobs.CompletedFeeds(t.completed_raw, t.completed_downstream_raw), root, CFG)
    written = jobs.live_job(spark, jobs.LiveFeeds(t.live_raw, t.live_downstream_raw, t.flow_daily), root, CFG)
    assert set(written) == {"individuals", "daily", "sfc_flow", "alldaily", "run_stats"}
    stats = marts.read_mart(spark, root, "run_stats")
    cols = ["dummy_date", "species", "median_percentcomplete", "min_percentcomplete", "max_percentcomplete"]
    a = sorted(tuple(r) for r in stats.select(*cols).collect())
    b = sorted(tuple(r) for r in t.run_stats.select(*cols).collect())  # no NULLs in these columns
    assert a == b and a
    # species-partitioned mart: the species predicate prunes partitions
    plan = marts.read_mart(spark, root, "daily").filter(F.col("species") == "Steelhead")._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(species" in plan.executedPlan().toString()
    d = jobs.dashboard_marts(spark, root, CFG)
    assert d.latest_discharge.count() == 1
    assert d.unique_fish.count() == t.individuals.select("species").distinct().count()


def _land(df, headers: dict, folder, parts: int, name: str, **how) -> list[str]:
    pdf = df.orderBy("ordinal").toPandas()
    paths = []
    for k in range(parts):
        out = pdf.iloc[k * len(pdf) // parts:(k + 1) * len(pdf) // parts][list(headers.values())].copy()
        out.columns = list(headers)
        path = folder / f"{name}{k}.csv"
        path.write_bytes(out.to_csv(index=False, lineterminator="\r\n").encode(how.get("encoding", "utf-8")))
        paths.append(str(path))
    return paths


def test_jobs_from_landed_files_equal_the_table_fed_ones(spark, sf_dir, tmp_path):
    t = RunTables.from_driver_tables(spark, sf_dir, CFG)
    utf16 = {"encoding": "UTF-16LE", "line_sep": "\r\n"}
    read = lambda paths, feed, **how: feeds.read_report(spark, paths, feed, **how)
    live = read(_land(t.live_raw, feeds.LIVE_DETECTIONS, tmp_path, 1, "live", encoding="utf-16-le"), "live_detections", **utf16)
    live_ds = read(_land(t.live_downstream_raw, feeds.LIVE_DOWNSTREAM, tmp_path, 2, "lds", encoding="utf-16-le"), "live_downstream", **utf16)
    done = read(_land(t.completed_raw, feeds.COMPLETED_DETECTIONS, tmp_path, 1, "done"), "completed_detections")
    done_ds = read(_land(t.completed_downstream_raw, feeds.COMPLETED_DOWNSTREAM, tmp_path, 6, "dds"), "completed_downstream")
    roots = [str(tmp_path / "files"), str(tmp_path / "tables")]
    for root, lv, dn in ((roots[0], (live, live_ds), (done, done_ds)),
                         (roots[1], (t.live_raw, t.live_downstream_raw), (t.completed_raw, t.completed_downstream_raw))):
        jobs.completed_years_job(jobs.CompletedFeeds(*dn), root, CFG)
        jobs.live_job(spark, jobs.LiveFeeds(*lv, t.flow_daily), root, CFG)
    for mart in ("daily_completed", "individuals", "daily", "sfc_flow", "alldaily", "run_stats"):
        a, b = (sorted(map(str, marts.read_mart(spark, r, mart).drop("ordinal").collect())) for r in roots)
        assert a == b and a, mart


def test_river_values_long_and_wide(spark, sf_dir, tmp_path):
    path = str(tmp_path / "river")
    fixtures.river_daily_long(spark, sf_dir).withColumn("site_no", F.lit("g")).write.parquet(path)
    end = dt.date(1999, 12, 31)
    got = river.read_long(spark, path, "g", end)
    want = fixtures.river_daily(spark, sf_dir).filter(F.col("date") <= F.lit(end))
    rows = sorted(map(tuple, got.select("date", "mean_temp", "mean_discharge").collect()))
    assert rows == sorted(map(tuple, want.select("date", "mean_temp", "mean_discharge").collect())) and rows
    wide = spark.sql("SELECT timestamp'2001-05-01 00:00:00' AS Date, 3 AS X_00010_00003, 8 AS X_00060_00003")
    assert tuple(river.from_wide(wide).first()) == (dt.date(2001, 5, 1), 3.0, 8.0)
    early = spark.sql("SELECT date'1989-12-31' AS date, 'g' AS site_no, '00060' AS parameter_cd, 1.0 AS value")
    early.write.parquet(str(tmp_path / "early"))
    assert river.read_long(spark, str(tmp_path / "early"), None, end).count() == 0  # history starts in 1990
