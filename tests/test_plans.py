"""Plan-shape guards: the properties the pipelines rely on at scale."""

import re

import pytest

from runtally import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _initial(df) -> str:
    """Physical plan before AQE re-planning (static shape, no runtime stats)."""
    p = _plan(df)
    return p.split("== Initial Plan ==")[-1] if "Initial Plan" in p else p


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return registry.tables(spark, sf_dir)


def test_columns_reach_the_scan_and_no_input_is_cut_or_spread(t):
    p = _initial(t.detections)
    orders_scan = [l for l in p.splitlines() if "FileScan parquet" in l and "o_orderdate" in l][0]
    assert "LessThan" not in orders_scan and "RoundRobin" not in p
    # only the columns the feed needs are read
    assert "o_clerk" not in orders_scan and "o_comment" not in orders_scan


def test_individuals_live_shuffles_detections_once_on_pit_id(t):
    p = _initial(t.individuals)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    on_pit = [e for e in exchanges if e.startswith("pit_id")]
    # one for the detections, one for the downstream table; nothing else
    assert len(on_pit) == 2 and len(exchanges) == 2, exchanges
    # partial aggregation before the shuffle (skewed fish reduced map-side)
    assert "partial_min_by" in p and "partial_max" in p
    assert "Window" not in p


def test_individuals_completed_reads_detections_once(t):
    p = _initial(t.completed_individuals)
    scans = [l for l in p.splitlines() if "FileScan parquet" in l and "o_orderstatus" in l]
    assert len(scans) == 1, scans
    # the only window runs on per-(fish, species, year) aggregates
    assert p.index("Window") < p.index("partial_min_by")


def _indent(line: str) -> int:
    m = re.search(r"[+:]- ", line)
    return m.start() if m else 0


def _scans_without_aggregate_below_window(plan: str) -> list[str]:
    """Scans reached from a Window without an aggregate on the path."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if not re.search(r"[+:]- Window |^Window ", line):
            continue
        base = _indent(line)
        stack = [(base, False)]
        for nxt in lines[i + 1:]:
            ind = _indent(nxt)
            if ind <= base:
                break
            while stack and stack[-1][0] >= ind:
                stack.pop()
            has_agg = (stack[-1][1] if stack else False) or "Aggregate" in nxt
            if "FileScan" in nxt and not has_agg:
                bad.append(nxt.strip()[:80])
            stack.append((ind, has_agg))
    return bad


def test_no_window_over_raw_detections(t):
    for df in (t.individuals, t.completed_individuals, t.daily, t.daily_completed, t.run_stats):
        assert _scans_without_aggregate_below_window(_initial(df)) == []


def test_scalars_are_subqueries(t):
    """Scalar bounds (flow window's first day, global max year) are scalar
    subqueries, never a join or an unpartitioned window."""
    from runtally import config as C
    from runtally.plans import canonical
    for df in (t.flow, canonical.current_year_detections(t.detections, C.FIXTURE_CONFIG, with_most_recent=True)):
        p = _initial(df)
        assert "scalar-subquery" in p or "Subquery" in p
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p and "Window" not in p


def test_species_mart_filter_is_partition_pruning(spark, tmp_path, t):
    from pyspark.sql import functions as F

    from runtally.sources import marts
    marts.write_mart(t.daily, str(tmp_path), "daily")
    df = marts.read_mart(spark, str(tmp_path), "daily").filter(F.col("species") == "Chinook")
    assert "PartitionFilters: [isnotnull(species" in _plan(df)


def test_walker_flags_a_window_over_raw_rows(t):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = t.detections.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("pit_id")))
    assert _scans_without_aggregate_below_window(_initial(bad))


def test_latest_rows_are_limited_in_each_task_and_the_clock_is_parsed_once(spark, sf_dir):
    from runtally import registry
    p = _initial(registry.QUERIES["inner_join_latest"](spark, sf_dir))
    assert "SortAggregate" not in p and p.count("WindowGroupLimit") == 4  # before and after each exchange
    assert p.count("gettimestamp(") == 2, p.count("gettimestamp(")


def test_filters_on_the_clock_do_not_repeat_its_parse(t):
    assert _initial(t.current_detections).count("gettimestamp(concat") == 1
    p = _initial(t.completed_detections.select("pit_id", "observation_datetime"))
    assert p.count("+00:00") == 1


def _host_zone(spark, sf_dir):
    from runtally import config as C
    from runtally.plans.context import RunTables
    return RunTables.from_driver_tables(spark, sf_dir, C.FIXTURE_CONFIG_HOST_ZONE)


def test_scheduled_run_reads_the_downstream_report_once(spark, sf_dir):
    host = _host_zone(spark, sf_dir)
    for df in (host.run_stats, host.year_to_date):
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert p.count("partial_max(_as_read") == p.count("partial_max(_parsed") >= 1
        # of the two uses one reads the exchange of the other
        assert "ReusedExchange [pit_id" in p


def test_shared_downstream_times_equal_the_separate_ones(spark, sf_dir):
    from runtally.plans import canonical
    host = _host_zone(spark, sf_dir)
    raw = host.live_downstream_raw.unionByName(spark.createDataFrame(
        [("bad", "A - x", "R", "13/45/2001 1:00:00 AM", (1, 1, 1)), ("odd", "A - x", "R", "3/5/2001 1:00:00", (2, 1, 1)),
         (None, "A - x", "R", "3/5/2001 12:30:00 PM", (3, 1, 1)), ("none", None, None, None, (4, 1, 1))],
        "tag string, site string, release_site string, obs_time string, ordinal struct<line:bigint,part:bigint,supp:bigint>"))
    host.live_downstream_raw = host.completed_downstream_raw = raw
    for got, ampm in ((host.downstream_latest_time, "ignore"), (host.completed_downstream_latest_time, "parse")):
        want = canonical.latest_downstream_time(canonical.downstream_detections(raw, ampm))
        rows = [tuple(r) for r in got.filter("latest_downstream IS NOT NULL").collect()]
        assert sorted(rows, key=str) == sorted(map(tuple, want.collect()), key=str) and rows


def test_rows_that_count_nowhere_are_dropped_before_the_clock_is_parsed(spark, t):
    from runtally.plans import canonical, completed
    raw = spark.createDataFrame(t.completed_raw.limit(5).collect(), t.completed_raw.schema)
    det = canonical.completed_detections(raw)
    p = _initial(completed.individuals_completed_single_pass(det, t.completed_downstream_latest_time, t.cfg))
    below_parse = p[p.index("Generate explode"):].split("ExistingRDD")[0]
    assert any("Filter" in l and "NEWSOC" in l for l in below_parse.splitlines())


def test_padded_report_text_is_cast_and_other_text_parsed_by_its_pattern(spark):
    from pyspark.sql import functions as F

    from runtally import config as C
    from runtally.functions import columns as X

    def by_pattern(ampm):
        t = F.col("t") if ampm == "parse" else F.regexp_extract("t", r"^\S+ \S+", 0)
        fmt = C.OBS_TIME_FORMAT if ampm == "parse" else C.OBS_TIME_FORMAT_NO_AMPM
        at = F.try_to_timestamp(F.concat(t, F.lit(" +00:00")), F.lit(fmt + " XXX"))
        return F.timestamp_add("MICROSECOND", F.unix_micros(at), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))

    days = ["03/05/2001", "3/5/2001", "02/29/2000", "02/29/2001", "02/30/2000", "13/01/2001", "00/10/2001", "04/31/1999",
            "12/31/0001", "01/01/0000", "01/01/9999", "1/1/20010", "03-05-2001", "03052001", "02302001", "3052001", ""]
    clocks = ["12:30:00 AM", "12:30:00 PM", "01:02:03 AM", "11:59:59 PM", "1:02:03 PM", "00:10:00 AM", "13:00:00 PM",
              "02:60:00 AM", "02:30:61 AM", "02:30:00", "02:30:00 pm", "02:30:00 XM", "02:30:00 PM\n", "02:30:00  PM"]
    text = [None, *days, *(f"{d} {c}" for d in days for c in clocks)]
    df = spark.createDataFrame([(x,) for x in text], "t string")
    for ampm in ("parse", "ignore"):
        got = df.select("t", X.parse_local_ts("t", ampm).alias("a"), by_pattern(ampm).alias("b"))
        assert got.filter("NOT (a <=> b)").collect() == [] and got.filter("a IS NOT NULL").count() > 20
        assert "timestamp_ntz) ELSE timestampadd" in _plan(got.select("a"))
    dates = df.select("t", X.parse_mdy("t").alias("a"), F.when(F.instr("t", "/") > 0, F.try_to_date("t", "M/d/yyyy"))
                      .otherwise(F.try_to_date("t", "MMddyyyy")).alias("b"))
    assert dates.filter("NOT (a <=> b)").collect() == [] and dates.filter("a IS NOT NULL").count() > 4
