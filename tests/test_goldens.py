"""Golden cases of the source job's tests (FIXTURES.md section 2), replayed in
batch. Windows of the snapshot queries are replayed as cumulative prefixes."""

import pytest
from pyspark.sql import functions as F

from fleetreports.operators import avg_report_gap, latest_per_key, positions, top_n
from fleetreports.plans import queries as q
from fleetreports.sources import make_reports


def ids(df, order=None):
    if order:
        df = df.orderBy(*order)
    return [r["id"] for r in df.collect()]


def rec(i, delay=0, t=0, vtype=1, bearing=0.0, laststop=0, line=1, name="L1"):
    return (str(i), vtype, bearing, line, name, delay, laststop, t)


def test_g1_north(spark):
    rows = [rec(1, bearing=340), rec(2, bearing=0), rec(3, bearing=90), rec(4, bearing=45)]
    out = q.north_reports(make_reports(spark, rows))
    assert sorted(ids(out)) == ["1", "2", "4"]  # equality, not only containment


def test_north_bounds(spark):
    rows = [rec(i, bearing=b) for i, b in enumerate([-1, 0, 45, 45.0001, 314.999, 315, 359.9, 360, 720])]
    out = q.north_reports(make_reports(spark, rows))
    kept = sorted(float(r["bearing"]) for r in out.collect())
    assert kept == [0.0, 45.0, 315.0, 359.9, 360.0, 720.0]


G2_W1 = [rec(1, vtype=5, laststop=10, t=10000), rec(2, vtype=5, laststop=20, t=10000),
         rec(3, vtype=5, laststop=80, t=10000), rec(4, vtype=5, laststop=15, t=10000)]
G2_W2 = [rec(1, vtype=5, laststop=20, t=20000), rec(3, vtype=5, laststop=80, t=20000),
         rec(5, vtype=5, laststop=80, t=20000)]


def test_g2_trains(spark):
    w1 = q.trains_last_stop(make_reports(spark, G2_W1))
    assert ids(w1, ["lastupdate", "id"]) == ["1", "2", "3", "4"]
    both = make_reports(spark, G2_W1 + G2_W2)
    out = q.trains_last_stop(both)
    # emission order of the source: oldest update first, then arrival
    seq = {r["id"]: r["seq"] for r in latest_per_key(both).collect()}
    ordered = sorted(out.collect(), key=lambda r: (r["lastupdate"], seq[r["id"]]))
    assert [r["id"] for r in ordered] == ["2", "4", "1", "3", "5"]
    stops = {r["id"]: r["laststopid"] for r in ordered}
    assert stops == {"1": 20, "2": 20, "3": 80, "4": 15, "5": 80}


def test_trains_only_vtype_5(spark):
    rows = [rec(1, vtype=5), rec(2, vtype=1), rec(3, vtype=4)]
    assert ids(q.trains_last_stop(make_reports(spark, rows))) == ["1"]


G3_W1 = [rec(1, delay=100, t=10000), rec(2, delay=60, t=10000), rec(3, delay=10, t=10000),
         rec(4, delay=50, t=10000), rec(7, delay=1, t=10000)]
G3_W2 = [rec(1, delay=0, t=20000), rec(5, delay=8, t=20000), rec(6, delay=5, t=20000)]


def test_g3_top5_core(spark):
    # the unfiltered core: latest per unit, then top 5 by delay
    core = lambda df: top_n(latest_per_key(df), 5)
    assert ids(core(make_reports(spark, G3_W1))) == ["1", "2", "4", "3", "7"]
    assert ids(core(make_reports(spark, G3_W1 + G3_W2))) == ["2", "4", "3", "5", "6"]


def test_g3_top5_deployed_and_current(spark):
    both = make_reports(spark, G3_W1 + G3_W2)
    assert ids(q.top_delayed(both)) == ["1", "2", "4", "3", "5"]
    assert ids(q.top_delayed_current(both)) == ["2", "4", "3", "5", "6"]
    assert ids(q.top_delayed(make_reports(spark, G3_W1))) == ["1", "2", "4", "3", "7"]


def test_top5_ties_keep_arrival_order(spark):
    rows = [rec(i, delay=7, t=1000) for i in (9, 3, 5, 1, 8, 2)]
    assert ids(q.top_delayed(make_reports(spark, rows))) == ["9", "3", "5", "1", "8"]


G4 = [rec(1, delay=100, t=10000), rec(2, delay=60, t=10000), rec(3, delay=10, t=10000),
      rec(4, delay=50, t=11000), rec(7, delay=1, t=11000), rec(5, delay=10, t=11000),
      rec(6, delay=5, t=60000), rec(10, delay=90, t=60000), rec(2, delay=70, t=62000),
      rec(8, delay=45, t=61000), rec(5, delay=15, t=61100), rec(6, delay=5, t=61000)]


def test_g4_top5_per_window(spark):
    out = q.top_delayed_window(make_reports(spark, G4), minutes=1).collect()
    by_window = {}
    for r in out:  # result is ordered: window, lastupdate, delay desc
        by_window.setdefault(r["window_start"], []).append(r)
    (w1, rows1), (w2, rows2) = sorted(by_window.items())
    assert [r["id"] for r in rows1] == ["1", "2", "3", "4", "5"]
    assert [r["id"] for r in rows2] == ["10", "8", "6", "5", "2"]
    six = [r for r in rows2 if r["id"] == "6"][0]
    assert six["lastupdate"].second == 1  # the newer report of unit 6
    # window end - 1 ms is the source's emission stamp
    assert (w2 - w1).total_seconds() == 60


G5 = [(100, 10000), (60, 10000), (10, 10000), (50, 10000), (1, 10000), (8, 10000),
      (5, 70000), (100, 70000), (70, 70000), (45, 70000), (15, 70000), (5, 70000)]


def test_g5_average(spark):
    rows = [rec(i, delay=d, t=t) for i, (d, t) in enumerate(G5)]
    out = q.average_delay(make_reports(spark, rows), minutes=1).orderBy("window_start").collect()
    assert [r["avg_delay"] for r in out] == [229 / 6, 40.0]
    assert out[0]["avg_delay"] == 38.166666666666664


G6_ID1 = [1000, 2000, 3000, 4000, 5000]
G6_ID2 = [1000, 1500, 3000, 3750, 5200, 6200]
G6_EXPECT = {"1": [0.0, 1.0, 1.0, 1.0, 1.0], "2": [0.0, 0.5, 1.0, 0.9166666666666666, 1.05, 1.175]}


def g6_records():
    out = []
    for a, b in zip(G6_ID1, G6_ID2):
        out += [rec(1, t=a), rec(2, t=b)]
    out.append(rec(2, t=G6_ID2[-1]))
    return out


@pytest.mark.parametrize("strategy", ["window", "distributed", "auto"])
def test_g6_gap(spark, strategy):
    df = make_reports(spark, g6_records())
    # id 2 (6 rows) is hot; the size shortcut is switched off to exercise the split
    kw = {"hot_key_rows": 5} if strategy == "auto" else {}
    out = avg_report_gap(df, n=5, strategy=strategy, **kw).orderBy("id", "lastupdate", "seq").collect()
    got = {}
    for r in out:
        got.setdefault(r["id"], []).append(r["avg_gap_s"])
    assert got == G6_EXPECT


def test_gap_default_is_ten_reports(spark):
    rows = [rec(1, t=1000 * (i + 1) + (i * i)) for i in range(15)]
    out = q.report_gap(make_reports(spark, rows)).orderBy("lastupdate").collect()
    stamps = [1000 * (i + 1) + (i * i) for i in range(15)]
    expect = []
    for i in range(15):
        lo = max(0, i - 9)
        expect.append(0.0 if i == 0 else (stamps[i] - stamps[lo]) / (i - lo) / 1000.0)
    assert [r["avg_gap_s"] for r in out] == expect


def test_inactive_reports_are_dropped_everywhere(spark):
    df = make_reports(spark, [rec(1, delay=5, t=1000), rec(2, delay=9, t=1000)]).withColumn(
        "isinactive", F.when(F.col("id") == "2", "true").otherwise("false"))
    assert ids(q.passthrough(df)) == ["1"]
    assert ids(q.top_delayed(df)) == ["1"]
    assert [r["avg_delay"] for r in q.average_delay(df).collect()] == [5.0]


def test_gap_strategies_agree_on_events(spark):
    from fleetreports.sources import event_reports

    reports = q.passthrough(event_reports(spark, "/root/testdata/sf0.001"))
    base = sorted(avg_report_gap(reports, strategy="window").collect())
    assert len(base) > 0
    assert sorted(avg_report_gap(reports, strategy="distributed", num_partitions=5).collect()) == base
    split = avg_report_gap(reports, strategy="auto", hot_key_rows=60)
    assert sorted(split.collect()) == base


def test_latest_methods_agree(spark):
    from fleetreports.sources import event_reports

    reports = event_reports(spark, "/root/testdata/sf0.001")
    a = latest_per_key(reports, ["id"], method="rank")
    b = latest_per_key(reports, ["id"], method="aggregate")
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_results_do_not_depend_on_session_time_zone(spark):
    from fleetreports.sources import event_reports

    reports = event_reports(spark, "/root/testdata/sf0.001")

    def snapshot():
        return (sorted(q.report_gap(reports).collect()), sorted(q.average_delay(reports, 1).collect()),
                sorted(q.top_delayed_window(reports, 24 * 60).collect()))

    before = snapshot()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert snapshot() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_millis_conversions_are_zone_free(spark):
    import datetime as dt

    from fleetreports.functions.coerce import millis_to_ntz, ntz_to_millis

    ms = [1710035999123, 1710037800001, 1710039600999, 5, 1730597400000, 1730601000000]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(m,) for m in ms], "ms bigint")
        out = df.select("ms", millis_to_ntz(F.col("ms")).alias("ts")).select(
            "ms", "ts", ntz_to_millis(F.col("ts")).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r in out:
        assert r.ts == dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=r.ms)
        assert r.back == r.ms


def test_gap_halo_reaches_over_several_partitions(spark):
    """Partitions that hold fewer than n - 1 reports of a unit hand on what came before them."""
    rows = [rec(u, t=1000 * k * k + 1000) for u, many in ((1, 60), (2, 3), (3, 1)) for k in range(many)]
    df = make_reports(spark, rows)
    for n in (1, 2, 10, 100):
        want = sorted(avg_report_gap(df, n=n, strategy="window").collect())
        assert len(want) == 64
        assert sorted(avg_report_gap(df, n=n, strategy="distributed", num_partitions=20).collect()) == want


def test_positions(spark):
    df = make_reports(spark, [rec(u, t=1000 * (50 - k)) for u, many in ((1, 50), (2, 3)) for k in range(many)])
    got = positions(df, num_partitions=7).select("id", "lastupdate", "pos").orderBy("id", "lastupdate").collect()
    assert [r.pos for r in got] == [*range(1, 51), 1, 2, 3]
