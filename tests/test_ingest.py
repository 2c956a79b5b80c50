"""JSON feed ingest: coercion, defaults, quarantine, lineage."""

import datetime as dt
import json
import os

from fleetreports.plans import queries as q
from fleetreports.functions import rsvp_id
from fleetreports.sources import ingest, parse_messages, record_message
from fleetreports.schema import REPORT_COLUMNS, REPORT_SCHEMA


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def msg(**attrs):
    return json.dumps({"attributes": attrs})


EDGE = [
    msg(id=17, vtype="5", delay=5.7, bearing="12.5", isinactive=False, lastupdate=1700000000123, linename="L9"),
    msg(id="a", vtype=1, delay="abc", lineid="7", isinactive="false", lastupdate="1700000001000", linename=None),
    msg(id="b", course={"x": 1}, lf=[1, 2], isinactive="false", lastupdate=1700000002000, delay=-3.9),
    json.dumps({"other": 1}),
    "not json",
    "",
    msg(id="c", isinactive=True, lastupdate=1700000003000),
    msg(id="d", lastupdate=1700000004000),
    msg(id="e", isinactive="false", lastupdate=1700000005000),
]


def test_edge_rows(spark, scratch_dir):
    write_lines(scratch_dir, "part-0.json", EDGE)
    got = ingest(spark, scratch_dir)
    reports = got.reports
    assert [f.name for f in reports.schema.fields] == list(REPORT_COLUMNS)
    assert [f.dataType for f in reports.schema.fields] == [f.dataType for f in REPORT_SCHEMA.fields]
    rows = {r["id"]: r for r in reports.collect()}
    r17 = rows["17"]
    assert (r17.vtype, r17.delay, r17.bearing, r17.isinactive, r17.linename) == (5, 5.0, 12.5, "false", "L9")
    assert r17.lastupdate == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    ra = rows["a"]
    assert (ra.delay, ra.lineid, ra.linename, ra.lastupdate.second) == (0.0, 7, "", 21)
    rb = rows["b"]
    assert (rb.course, rb.lf, rb.delay) == ("", "", -3.0)  # containers have no text; truncation toward 0
    assert rows["e"].bearing == 0.0  # missing bearing -> 0.0
    # default records: no attributes / empty line -> id '' and inactive ''
    assert rows[""].isinactive == ""
    quarantine = sorted((r.value, r.reason) for r in got.quarantine.collect())
    assert quarantine == [("", "empty_message"), ("not json", "malformed_json")]

    active_ids = sorted(r.id for r in q.passthrough(reports).collect())
    assert active_ids == ["17", "a", "b", "e"]  # isinactive true / missing dropped
    north_ids = sorted(r.id for r in q.north_reports(reports).collect())
    assert north_ids == ["17", "a", "b", "e"]  # bearing 12.5 and missing (0.0) are north


def test_seq_is_unique(spark, scratch_dir):
    write_lines(scratch_dir, "a.json", [msg(id=i, isinactive="false") for i in range(50)])
    write_lines(scratch_dir, "b.json", [msg(id=i, isinactive="false") for i in range(50)])
    seqs = [r.seq for r in ingest(spark, scratch_dir).reports.collect()]
    assert len(seqs) == len(set(seqs)) == 100


def test_lineage(spark):
    raw = spark.createDataFrame(
        [(json.dumps({"rsvp_id": 42, "attributes": {}}),), (json.dumps({"attributes": {}}),), ("not json",), ("[1]",)],
        "value string",
    )
    got = parse_messages(raw, with_lineage=True)
    rows = got.reports.collect()
    assert sorted(r.rsvp_id for r in rows) == ["42", "NOT FOUND"]
    # text that is no JSON object cannot become a report: it is set aside
    assert sorted(r.value for r in got.quarantine.collect()) == ["[1]", "not json"]
    probe = raw.select(rsvp_id(raw.value).alias("r")).collect()
    assert sorted(r.r for r in probe) == ["42", "NOT FOUND", "NULL", "NULL"]
    hashes = {r.payload_hash for r in rows}
    assert all(len(h) == 32 and h == h.upper() for h in hashes)


def test_record_message_round_trip(spark, scratch_dir):
    rec = ("7", 5, 350.0, 3, "L3", 12, 44, 1700000000000)
    write_lines(scratch_dir, "x.json", [record_message(rec)])
    r = ingest(spark, scratch_dir).reports.collect()[0]
    assert (r.id, r.vtype, r.ltype, r.bearing, r.lineid, r.linename, r.delay, r.laststopid, r.finalstopid,
            r.isinactive) == ("7", 5, 5, 350.0, 3, "L3", 12.0, 44, -1, "false")


def test_null_messages_are_skipped(spark):
    raw = spark.createDataFrame([(None,), (msg(id="x", isinactive="false"),)], "value string")
    got = parse_messages(raw)
    assert [r.id for r in got.reports.collect()] == ["x"]
    assert got.quarantine.count() == 0


def test_stream_seq_stays_positive_for_decades(spark):
    from pyspark.sql import functions as F

    from fleetreports.sources.feed import _HASH_BITS

    far = 8_700_000_000_000  # epoch ms in the 2240s
    assert (far << _HASH_BITS) + (1 << _HASH_BITS) - 1 < 1 << 63
    df = spark.createDataFrame([("x",)], "value string")
    row = df.select((F.lit(far).cast("bigint") * (1 << _HASH_BITS)).alias("hi")).collect()[0]
    assert row.hi > 0


def test_out_of_range_stamps_do_not_fail_the_job(spark):
    import datetime as dt

    raw = spark.createDataFrame(
        [(msg(id="a", isinactive="false", lastupdate=99999999999999999),),
         (msg(id="b", isinactive="false", lastupdate=-99999999999999999),),
         (msg(id="c", isinactive="false", lastupdate="1e300"),)],
        "value string",
    )
    rows = {r.id: r.lastupdate for r in parse_messages(raw).reports.collect()}
    assert rows == {k: dt.datetime(1970, 1, 1) for k in "abc"}


def test_more_edge_messages(spark):
    from fleetreports.plans import queries as q

    rows = [
        msg(id="a", isinactive="false", bearing="NaN", delay="NaN", lat="Infinity", lineid=1e30,
            vtype="9999999999", lastupdate=1700000000000),
        msg(id="b", isinactive="false", bearing=-0.0, delay=-0.5, lastupdate="  1700000000000  "),
        msg(id="c", isinactive=" false", lastupdate=1700000000000),
        '{"attributes": {"id": "d", "isinactive": "false", "lastupdate": 1700000000000}} trailing',
        '[{"attributes": {"id": "e"}}]',
        '{"attributes": "notanobject"}',
    ]
    got = parse_messages(spark.createDataFrame([(r,) for r in rows], "value string"))
    rep = {r.id: r for r in got.reports.collect()}
    a = rep["a"]
    assert (a.vtype, a.delay, a.lineid, a.lat) == (0, 0.0, 0, float("inf")) and a.bearing != a.bearing  # NaN
    assert rep["b"].delay == 0.0 and rep["b"].lastupdate.year == 2023
    assert sorted(r.id for r in q.north_reports(got.reports).collect()) == ["b", "d"]  # NaN is not north
    assert sorted(r.id for r in q.passthrough(got.reports).collect()) == ["a", "b", "d"]  # ' false' is not active
    assert sorted(r.reason for r in got.quarantine.collect()) == ["malformed_json", "malformed_json"]


def test_text_that_looks_like_a_container_stays(spark):
    lines = ['{"attributes":{"id":"[A]1","linename":"{x","course":["y"],"lf":{"z":1},"isinactive":" [f"}}',
             '{"attributes":{"id":"[B]2","linename":"[1, 2]","course":"[\\"q\\"]","lf":12,"isinactive":false}}']
    rows = parse_messages(spark.createDataFrame([(x,) for x in lines], "value string")).reports.collect()
    got = {r.id: (r.linename, r.course, r.lf, r.isinactive) for r in rows}
    assert got == {"[A]1": ("{x", "", "", " [f"), "[B]2": ("[1, 2]", '["q"]', "12", "false")}


def test_repeated_ingest_replaces_itself(spark, scratch_dir):
    import glob
    import os

    from fleetreports.sources.feed import read_report_table, write_report_tables

    lines = [record_message((str(i), 1, 0.0, 1, "L", i, 0, 86_400_000 * (i % 5))) for i in range(200)] + ["not json"]
    raw = spark.createDataFrame([(x,) for x in lines], "value string").repartition(16)
    for _ in range(2):
        write_report_tables(parse_messages(raw, with_lineage=True), scratch_dir, ingest_id="a")
    assert read_report_table(spark, scratch_dir).count() == 200
    write_report_tables(parse_messages(raw), scratch_dir, ingest_id="b")
    assert read_report_table(spark, scratch_dir).count() == 400
    bad = spark.read.parquet(os.path.join(scratch_dir, "quarantine", "ingest=a")).collect()
    assert [(r.reason, r.rsvp_id) for r in bad] == [("malformed_json", "NULL")]
    assert len(glob.glob(f"{scratch_dir}/reports/ingest=a/day=*/*.parquet")) <= 5 + 16  # not tasks x days
