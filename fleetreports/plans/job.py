"""Command-line job: one query per run, on a landing folder of JSON messages.

    python -m fleetreports.plans.job --north --input /landing [--output /out]
    python -m fleetreports.plans.job -5 --input /landing --batch

Streaming by default (``--once`` processes what is there and stops);
``--batch`` reads the folder as a table. Without ``--output`` results are
printed; with it, append results go to rolling text files, snapshots and
ranked windows to one folder per micro-batch. Malformed messages can be kept
with ``--quarantine``.
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys
import uuid

from pyspark.sql import SparkSession

from fleetreports.functions.render import render
from fleetreports.operators import active, without_repeats, without_stamp
from fleetreports.plans import registry
from fleetreports.session import build_session, checkpoint_root, stream_checkpoint
from fleetreports.sources.feed import (
    ingest,
    parse_messages,
    read_feed_stream,
    read_report_table,
    write_report_tables,
)
from fleetreports.streaming import sinks
from fleetreports.streaming.clock_windows import start_clock_windows
from fleetreports.streaming.incremental_top import start_top
from fleetreports.streaming.rolling import start_rolling


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(add_help=False)
    p.add_argument("-h", "--help", action="store_true")
    for spec in (*registry.QUERIES, *registry.EXTRA):
        names = [f"-{f}" if len(f) == 1 else f"--{f}" for f in spec.flags]
        p.add_argument(*names, dest=f"q_{spec.name}", action="store_true")
    p.add_argument("--input")
    p.add_argument("--reports", help="run on a report table written by --ingest-to (batch)")
    p.add_argument("--ingest-to", help="parse --input once into report and quarantine tables, then stop")
    p.add_argument("--lineage", action="store_true", help="with --ingest-to: keep rsvp_id and payload_hash columns")
    p.add_argument("--output", help="folder for the result lines (default: a new one beside the checkpoints, printed)")
    p.add_argument("--preview", type=int, help="batch: also show this many lines here")
    p.add_argument("--checkpoint")
    p.add_argument("--quarantine")
    p.add_argument("--stage", help="streams: parse the feed once into this parquet table, query from it "
                   "(automatic, under the checkpoint folder, when --quarantine is given)")
    p.add_argument("--batch", action="store_true")
    p.add_argument("--distinct", action="store_true", help="count a message that was delivered again only once")
    p.add_argument("--once", action="store_true")
    p.add_argument("--minutes", type=float)
    p.add_argument("--n", type=int)
    p.add_argument("--gap-strategy", choices=("auto", "window", "distributed"),
                   help="--diff in batch: how units are split (default auto)")
    p.add_argument("--max-files-per-trigger", type=int)
    # Bounds a micro-batch, so a backlog is processed in slices and no key
    # group of a stateful step grows with the backlog.
    # (Spark accepts one of the two limits; files win when given.)
    p.add_argument("--max-bytes-per-trigger", type=int, default=1 << 30)
    p.add_argument("--master")
    return p


def chosen(args: argparse.Namespace) -> registry.QuerySpec | None:
    flags = {"help"} if args.help else set()
    for spec in (*registry.QUERIES, *registry.EXTRA):
        if getattr(args, f"q_{spec.name}"):
            flags |= set(spec.flags)
    return registry.select(flags)


def run_batch_job(spark: SparkSession, spec: registry.QuerySpec, args: argparse.Namespace) -> None:
    if args.reports:
        reports = read_report_table(spark, args.reports)
        got = None
    else:
        # with two outputs, parse the JSON once (written to the shared folder)
        got = ingest(spark, args.input, materialize_parse=bool(args.quarantine))
        reports = got.reports
    if args.distinct:
        reports = without_repeats(reports)
    result = registry.run_batch(spec.name, reports, minutes=args.minutes, n=args.n, strategy=args.gap_strategy)
    rendered = render(result, spec.render)
    if args.quarantine:
        if got is not None:
            got.quarantine.write.mode("overwrite").json(args.quarantine)
        if spec.name == "diff":  # what the gap leaves out
            without_stamp(active(reports)).write.mode("overwrite").json(f"{args.quarantine.rstrip('/')}-gap")
    rendered.write.mode("overwrite").text(args.output)
    if args.preview:
        print(f"The first {args.preview} lines:")
        for row in spark.read.text(args.output).limit(args.preview).collect():
            print(row.value)


def start_stream_job(spark: SparkSession, spec: registry.QuerySpec, args: argparse.Namespace):
    raw = read_feed_stream(
        spark,
        args.input,
        args.max_files_per_trigger,
        None if args.max_files_per_trigger else args.max_bytes_per_trigger,
    )
    started = []
    once = {"availableNow": True} if args.once else None
    stage = args.stage
    if stage is None and args.quarantine:
        # two outputs of one feed: parse it once, into a table beside the checkpoints
        stage = (f"{args.checkpoint}-stage-table" if args.checkpoint
                 else os.path.join(checkpoint_root(spark), "fleetreports-stage", spec.name))
    if stage:
        stage_name = f"fleetreports_{spec.name}_staging"
        stage_ckpt = stream_checkpoint(spark, stage_name, args.checkpoint and f"{args.checkpoint}-staging")
        staging = sinks.start_staging(raw, stage, stage_name, stage_ckpt, once)
        if args.once:
            staging.awaitTermination()  # a replay reads the staged table once it is complete
        else:
            started.append(staging)
        got = sinks.read_staged(spark, stage, args.max_files_per_trigger, args.max_bytes_per_trigger)
    else:
        got = parse_messages(raw)
    reports = without_repeats(got.reports) if args.distinct else got.reports
    name = f"fleetreports_{spec.name}"
    ckpt = stream_checkpoint(spark, name, args.checkpoint)
    if args.quarantine:
        started.append(
            got.quarantine.writeStream.format("json").option("path", args.quarantine)
            .option("checkpointLocation", ckpt + "-quarantine").trigger(**(once or {"processingTime": "10 seconds"}))
            .start()
        )
    params = registry.params_for(spec, minutes=args.minutes, n=args.n, strategy=args.gap_strategy)
    if spec.output == "windowed":
        sink = sinks.text_batch_sink(args.output, spec.render)
        started.append(start_clock_windows(reports, sink, name, checkpoint=ckpt, **params))
        return started
    if spec.name == "average":
        def start(df, mode):
            return start_rolling(df, spec.render, args.output, name, ckpt, once)

        started.append(sinks.start_average_delay(reports, start, **params))
        return started
    if spec.render == "top":  # the global rankings
        sink = sinks.snapshot_writer(args.output, spec.render)
        started.append(start_top(reports, sink, name, current=spec.name == "delayed_current", checkpoint=ckpt, trigger=once, **params))
        return started
    df, mode = registry.stream_form(spec.name, reports, **params)
    if spec.output == "snapshot":
        started.append(sinks.start_snapshot(df, mode, args.output, name, spec.render, ckpt, once))
    else:
        started.append(start_rolling(df, spec.render, args.output, name, ckpt, once))
    return started


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spec = chosen(args)
    if spec is None:
        print(registry.help_text())
        return 0
    if not (args.input or (args.batch and args.reports)):
        print("--input (or --batch --reports) is required\n" + registry.help_text(), file=sys.stderr)
        return 2
    spark = build_session(args.master, app_name=f"fleetreports-{spec.name}")
    if args.ingest_to:
        write_report_tables(ingest(spark, args.input, with_lineage=args.lineage, materialize_parse=True),
                            args.ingest_to, ingest_id=hashlib.md5(args.input.encode()).hexdigest()[:12])
        return 0
    if not args.output:  # every line, wherever it was made; a terminal would show the driver's only
        args.output = os.path.join(checkpoint_root(spark), "fleetreports-lines", f"{spec.name}-{uuid.uuid4().hex[:8]}")
        print(f"Lines are written to {args.output}")
    # A finished feed has no window left open: windows are computed as a batch.
    if args.batch or (args.once and (spec.output == "windowed" or spec.name == "average")):
        run_batch_job(spark, spec, args)
        return 0
    for query in start_stream_job(spark, spec, args):
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
