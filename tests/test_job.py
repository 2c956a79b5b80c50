"""Query registry and command-line job."""

import os

from fleetreports.plans import registry
from fleetreports.plans.job import main
from tests.test_goldens import G3_W1, G3_W2, G4, rec
from tests.test_streaming import landing, msgs


def test_flag_dispatch_first_match_wins():
    assert registry.select({"north", "trains"}).name == "north"
    assert registry.select({"6", "3"}).name == "delayed"
    assert registry.select({"help", "north"}) is None
    assert registry.select(set()).name == "passthrough"
    assert registry.select({"delayedw"}).defaults == {"minutes": 3, "n": 5}
    assert registry.select({"average"}).defaults == {"minutes": 1}


def test_help(capsys):
    assert main(["--help"]) == 0
    out = capsys.readouterr().out
    assert "-1, --north" in out and "-6, --diff" in out


def read_lines(spark, folder):
    return [r.value for r in spark.read.text(folder).collect()]


def test_batch_north(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs([rec(1, bearing=340), rec(2, bearing=90)])])
    out = os.path.join(scratch_dir, "out")
    assert main(["--north", "--batch", "--input", folder, "--output", out]) == 0
    lines = read_lines(spark, out)
    assert len(lines) == 1 and lines[0].startswith("Vehicle{id='1'")


def said_folder(capsys):
    return next(x.split()[-1] for x in capsys.readouterr().out.splitlines() if x.startswith("Lines are written to"))


def test_all_lines_without_output(spark, scratch_dir, capsys):
    """Batch, stream and snapshot write every line, not a console's first 20."""
    folder = landing(os.path.join(scratch_dir, "in"), [msgs([rec(i, bearing=340, vtype=5) for i in range(100)])])
    assert main(["--batch", "--input", folder, "--preview", "3"]) == 0
    out = capsys.readouterr().out
    assert sum(x.startswith("Vehicle{") for x in out.splitlines()) == 3
    for flags in (["--batch"], ["--once"], ["--once", "--trains"]):
        assert main([*flags, "--input", folder, "--checkpoint", os.path.join(scratch_dir, "ck" + "".join(flags))]) == 0
        assert spark.read.text(said_folder(capsys), recursiveFileLookup=True).count() == 100


def test_stream_delayed_snapshots(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G3_W1), msgs(G3_W2)])
    out = os.path.join(scratch_dir, "out")
    args = ["-3", "--input", folder, "--output", out, "--once", "--max-files-per-trigger", "1",
            "--checkpoint", os.path.join(scratch_dir, "ck")]
    assert main(args) == 0
    batches = sorted(d for d in os.listdir(out) if d.startswith("batch="))
    last = read_lines(spark, os.path.join(out, batches[-1]))
    assert len(last) == 5 and all(line.startswith("ID:") for line in last)


def test_stream_windowed_replay(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G4[:6]), msgs(G4[6:])])
    out = os.path.join(scratch_dir, "out")
    args = ["--delayedw", "--minutes", "1", "--input", folder, "--output", out, "--once",
            "--max-files-per-trigger", "1", "--checkpoint", os.path.join(scratch_dir, "ck")]
    assert main(args) == 0
    lines = read_lines(spark, out)  # every window, the last one too
    ids = sorted(line.split(" ")[0] for line in lines)
    assert len(lines) == 10 and ids.count("ID:5") == 2


def test_stream_average_text(spark, scratch_dir):
    w1 = [rec(i, delay=d, t=10000) for i, d in enumerate([100, 60, 10, 50, 1, 8])]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(w1)])
    out = os.path.join(scratch_dir, "out")
    quarantine = os.path.join(scratch_dir, "bad")
    # no file limit: the default byte limit per micro-batch applies
    args = ["--average", "--input", folder, "--output", out, "--once",
            "--checkpoint", os.path.join(scratch_dir, "ck"), "--quarantine", quarantine]
    assert main(args) == 0
    assert read_lines(spark, out) == ["Average delay:38.166666666666664"]


def test_batch_with_quarantine_parses_once(spark, scratch_dir):
    lines = msgs([rec(1, bearing=340), rec(2, bearing=10)]) + ["not json", ""]
    folder = landing(os.path.join(scratch_dir, "in"), [lines])
    out, bad = os.path.join(scratch_dir, "out"), os.path.join(scratch_dir, "bad")
    assert main(["--north", "--batch", "--input", folder, "--output", out, "--quarantine", bad]) == 0
    assert len(read_lines(spark, out)) == 2
    reasons = sorted(r.reason for r in spark.read.json(bad).collect())
    assert reasons == ["empty_message", "malformed_json"]


def test_ingest_to_tables_then_query(spark, scratch_dir):
    lines = msgs(G3_W1 + G3_W2) + ["not json"]
    folder = landing(os.path.join(scratch_dir, "in"), [lines])
    table = os.path.join(scratch_dir, "table")
    assert main(["--input", folder, "--ingest-to", table]) == 0
    from fleetreports.sources import read_report_table
    from fleetreports.schema import REPORT_COLUMNS

    reports = read_report_table(spark, table)
    assert reports.columns[: len(REPORT_COLUMNS)] == list(REPORT_COLUMNS) and "day" in reports.columns
    assert reports.count() == 8
    assert [r.reason for r in spark.read.parquet(os.path.join(table, "quarantine")).collect()] == ["malformed_json"]
    out = os.path.join(scratch_dir, "out")
    assert main(["-3", "--batch", "--reports", table, "--output", out]) == 0
    ids = [line.split(" ")[0] for line in read_lines(spark, out)]
    assert sorted(ids) == sorted(["ID:1", "ID:2", "ID:4", "ID:3", "ID:5"])


def test_stream_with_staging_parses_once(spark, scratch_dir):
    w1 = [rec(i, delay=d, t=10000) for i, d in enumerate([100, 60, 10, 50, 1, 8])]
    closing = [rec(99, delay=0, t=130000)]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(w1) + ["not json"], msgs(closing)])
    out, bad, stage = (os.path.join(scratch_dir, d) for d in ("out", "bad", "stage"))
    args = ["--input", folder, "--output", out, "--once", "--stage", stage,
            "--checkpoint", os.path.join(scratch_dir, "ck"), "--quarantine", bad]
    assert main(args) == 0
    assert len(read_lines(spark, out)) == 7
    assert [r.reason for r in spark.read.json(bad).collect()] == ["malformed_json"]
    staged = spark.read.parquet(stage)
    assert staged.count() == 8 and staged.filter("_reason IS NOT NULL").count() == 1


def test_ingest_with_lineage(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G3_W1)])
    table = os.path.join(scratch_dir, "table")
    assert main(["--input", folder, "--ingest-to", table, "--lineage"]) == 0
    from fleetreports.sources import read_report_table

    rows = read_report_table(spark, table).select("rsvp_id", "payload_hash").collect()
    assert len(rows) == 5 and {r.rsvp_id for r in rows} == {"NOT FOUND"}
    assert all(len(r.payload_hash) == 32 for r in rows)


def test_registry_is_consistent(spark):
    from fleetreports.functions import render
    from fleetreports.sources import make_reports

    reports = make_reports(spark, G4)
    for name, spec in registry.BY_NAME.items():
        assert spec.output in ("append", "snapshot", "windowed"), name
        assert (spec.stream is None) == (spec.output == "windowed"), name
        result = registry.run_batch(name, reports)
        assert render(result, spec.render).count() == result.count(), name
    # parameter overrides reach the query; unknown parameters are ignored
    one = registry.run_batch("average", reports, minutes=1, n=99).count()
    three = registry.run_batch("average", reports, minutes=3).count()
    assert (one, three) == (2, 1)


def test_gap_strategy_option(spark, scratch_dir):
    from tests.test_goldens import g6_records

    folder = landing(os.path.join(scratch_dir, "in"), [msgs(g6_records())])
    outs = {}
    for strategy in ("window", "distributed"):
        out = os.path.join(scratch_dir, strategy)
        assert main(["-6", "--batch", "--n", "5", "--gap-strategy", strategy, "--input", folder,
                     "--output", out]) == 0
        outs[strategy] = sorted(read_lines(spark, out))
    assert outs["window"] == outs["distributed"] and len(outs["window"]) == 11
    assert "ID: 2 Average: 1.175" in outs["window"]
