"""Property tests against plain-Python models of the source job's operators."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from fleetreports.operators import avg_report_gap, latest_per_key, top_n
from fleetreports.sources import make_reports

SETTINGS = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    phases=[Phase.explicit, Phase.reuse, Phase.generate],  # shrinking through Spark is too slow
)

reports_st = st.lists(
    st.tuples(st.integers(1, 4), st.integers(1, 5_000_000), st.integers(-30, 60)),
    min_size=1,
    max_size=40,
)


def to_records(rows):
    return [(str(i), 1, 0.0, 1, "L1", d, 0, t) for i, t, d in rows]


def mean_gaps(stamps, n):
    """After each stamp: the mean difference, in seconds, of neighbours among
    the last n stamps; 0.0 where there is one only."""
    recent = [stamps[max(0, j + 1 - n):j + 1] for j in range(len(stamps))]
    return [sum(b - a for a, b in zip(r, r[1:])) / (len(r) - 1) / 1000 if len(r) > 1 else 0.0 for r in recent]


@SETTINGS
@given(rows=reports_st, n=st.integers(1, 6), strategy=st.sampled_from(["window", "distributed"]))
def test_gap_equals_definition(spark, rows, n, strategy):
    df = make_reports(spark, to_records(rows))
    got = avg_report_gap(df, n=n, strategy=strategy, num_partitions=3).collect()
    by_id = {}
    for seq, (i, t, _) in enumerate(rows):
        by_id.setdefault(str(i), []).append((t, seq))
    expect = {}
    for i, items in by_id.items():
        items.sort()
        for (t, seq), g in zip(items, mean_gaps([t for t, _ in items], n)):
            expect[seq] = g
    assert {r.seq: r.avg_gap_s for r in got} == expect


@SETTINGS
@given(rows=reports_st, k=st.integers(1, 6))
def test_latest_then_top_n_matches_sort(spark, rows, k):
    df = make_reports(spark, to_records(rows))
    latest = latest_per_key(df, ["id"])
    got = [r.id for r in top_n(latest, k).collect()]
    newest = {}
    for seq, (i, t, d) in enumerate(rows):
        key = (t, seq)
        if str(i) not in newest or key > newest[str(i)][0]:
            newest[str(i)] = (key, d)
    ranked = sorted(newest.items(), key=lambda kv: (-kv[1][1], kv[1][0][0], kv[1][0][1], kv[0]))
    assert got == [i for i, _ in ranked[:k]]
    assert latest.count() == len(newest)
