"""Equality of whole reports."""

from fleetreports.operators.filters import same_report
from fleetreports.sources import make_reports
from tests.test_goldens import rec


def test_same_report_compares_every_field(spark):
    base = rec(1, delay=5, t=10_000, bearing=float("nan"))
    rows = [base, base, rec(2, delay=5, t=10_000), rec(1, delay=6, t=10_000), rec(1, delay=5, t=10_001)]
    reports = make_reports(spark, rows)
    pairs = reports.alias("a").join(reports.alias("b"), same_report("a", "b")).selectExpr("a.seq AS a", "b.seq AS b").collect()
    assert sorted((r.a, r.b) for r in pairs) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 3), (4, 4)]
