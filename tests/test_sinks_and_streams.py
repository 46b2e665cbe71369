import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger as g, rolls
from millrace.sinks import imports, text, topics as topic_sink
from millrace.sources import topics as topic_source
from millrace.sources.lines import list_files, read_lines
from millrace.streaming import jobs

RECORDS = "topic string, partition int, offset bigint, value string"
HOUR = 3_600_000


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def names(spark, folder, glob=""):
    return {r["path"] for r in list_files(spark, f"{folder}{glob}").collect()}


def test_lines_are_written_once_and_nulls_reported(spark, rows, tmp_path):
    df = rows([("a",), (None,), ("é",)], "value string")
    text.write_lines(df, str(tmp_path / "out"))
    assert sorted(r[0] for r in read_lines(spark, str(tmp_path / "out")).collect()) == ["a", "é"]
    assert text.null_lines(df).count() == 1


def test_hourly_files_hold_every_line(spark, tmp_path):
    lines = spark.range(1000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3 * HOUR).alias("ts_ms"), F.col("id").cast("string").alias("line"), F.col("id").alias("offset")
    )
    out = str(tmp_path / "out")
    for part in range(4):  # written in turns, as by several writers
        text.write_hourly(lines.where(F.col("id") % 4 == part), out, max_rows=50)
    files = [p.removeprefix("file:") for p in names(spark, out, "/topic=t/dt=19700101/*")]
    assert {p.split("/hr=")[1][:10] for p in files} == {"1970010100", "1970010101", "1970010102"}
    assert all(len(gzip.open(p).read().splitlines()) <= 50 for p in files)
    assert sum(len(gzip.open(p).read().splitlines()) for p in files) == 1000
    back = spark.read.text(out)
    assert back.where("month(to_date(dt, 'yyyyMMdd')) = 1 and hr like '1970%'").count() == 1000
    assert dict(back.dtypes)["hr"] == "string"


def test_salted_writing_splits_a_hot_hour(spark, tmp_path):
    lines = spark.range(1000).select(F.lit("t").alias("topic"), F.lit(0).cast("bigint").alias("ts_ms"), F.col("id").cast("string").alias("line"), F.col("id").alias("offset"))
    text.write_hourly(lines, str(tmp_path / "out"), salt="offset", salts=4)
    assert spark.read.text(str(tmp_path / "out")).count() == 1000


def landed(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    for name, lines in (("web_12_hr_2014010203.txt", ["a", "b"]), ("app_7_hr_2014010204.txt", ["c"]), ("stray_1_hr_2014010204.txt", ["d"])):
        (folder / name).write_text("\n".join(lines) + "\n")
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    uri = f"file://{folder}/"
    units = spark.createDataFrame([("r", uri + n) for n in ("web_12_hr_2014010203.txt", "app_7_hr_2014010204.txt", "gone_1_hr_2014010205.txt")], "ds string, id string")
    table.mark_run(units, at(), "run-0")
    return folder, units, table


def imported(spark, out):
    schema = "value string, batch string, type string, dt string, hr string, src string"
    got = spark.read.schema(schema).text(str(out))
    return sorted((r["type"], r["dt"], r["hr"], r["src"], r["value"]) for r in got.collect())


WEB = [("web", "20140102", "2014010203", "h-web_12_hr_2014010203.txt", v) for v in "ab"]
APP = [("app", "20140102", "2014010204", "h-app_7_hr_2014010204.txt", "c")]


def run_import(spark, tmp_path, units, table, **options):
    imports.import_files(spark, units, str(tmp_path / "out"), table, "0", "h", at(), **options)


def test_import_takes_tracked_files_and_counts_missing_ones_done(spark, tmp_path):
    folder, units, table = landed(spark, tmp_path)
    for _ in range(2):  # a repeated batch changes nothing
        run_import(spark, tmp_path, units, table)
    assert imported(spark, tmp_path / "out") == APP + WEB
    assert {r["status"]: r["n"] for r in g.status_counts(table.state(), "r").collect()} == {"done": 3}
    missing = imports.missing_units(spark, str(folder), units).collect()
    assert [r["id"].rsplit("/", 1)[1] for r in missing] == ["gone_1_hr_2014010205.txt"]


def test_only_the_files_of_units_are_opened(spark, tmp_path):
    folder, units, table = landed(spark, tmp_path)
    (folder / "stray_1_hr_2014010204.txt").chmod(0)
    (folder / "broken_1_hr_2014010204.txt.gz").write_text("this is not gzip")
    run_import(spark, tmp_path, units, table, landed=str(folder))
    assert imported(spark, tmp_path / "out") == APP + WEB
    assert {r["status"]: r["n"] for r in g.status_counts(table.state(), "r").collect()} == {"done": 2, "run": 1}


def test_files_are_deleted_after_they_are_done(spark, tmp_path, monkeypatch):
    folder, units, table = landed(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(imports, "delete_files", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            run_import(spark, tmp_path, units, table, delete=True)
    assert len(list(folder.iterdir())) == 3
    run_import(spark, tmp_path, units, table, delete=True)  # goes on where it was stopped
    assert [f.name for f in folder.iterdir()] == ["stray_1_hr_2014010204.txt"]
    assert imported(spark, tmp_path / "out") == APP + WEB


def test_imports_take_so_many_files_at_a_time(spark, tmp_path):
    folder, units, table = landed(spark, tmp_path)
    for batch in "01":
        imports.import_files(spark, g.replay_run(table.state(), "r").select("ds", F.col("ids").alias("id")), str(tmp_path / "out"), table, batch, "h", at(), landed=str(folder), max_files=1)
    assert imported(spark, tmp_path / "out") == APP + WEB


def test_import_by_the_models_of_the_user(spark, tmp_path):
    folder, units, table = landed(spark, tmp_path)
    run_import(spark, tmp_path, units, table, dir_model=2)
    got = spark.read.schema("value string, batch string, type string, year string, month string, day string, hour string, src string").text(str(tmp_path / "out"))
    assert {(r["year"], r["month"], r["day"], r["hour"]) for r in got.collect()} == {("2014", "01", "02", "03"), ("2014", "01", "02", "04")}


def test_import_stopped_before_done_is_repeated(spark, tmp_path, monkeypatch):
    folder, units, table = landed(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(g.LedgerTable, "mark_done", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            run_import(spark, tmp_path, units, table)
    assert g.replay_run(table.state(), "r").count() == 3
    again = g.replay_run(table.state(), "r").select("ds", F.col("ids").alias("id"))
    run_import(spark, tmp_path, again, table)
    assert imported(spark, tmp_path / "out") == APP + WEB
    assert g.replay_run(table.state(), "r").count() == 0


def test_manifest_names_the_remote_file(spark, tmp_path):
    units = spark.createDataFrame([("r", "/l/web_12_hr_2014010203.gz")], "ds string, id string")
    got = imports.import_manifest(units, "h", dir_model=2).first()
    assert got["remote"] == "/log/raw/web/year=2014/month=01/day=02/hour=03/h-web_12_hr_2014010203.gz"


def test_delete_is_repeatable(spark, tmp_path):
    files = [tmp_path / f"f{i}" for i in range(3)]
    for f in files[:2]:
        f.write_text("x")
    df = spark.createDataFrame([(f.as_uri(),) for f in files], "path string")
    for _ in range(2):
        assert [r["deleted"] for r in imports.delete_files(df).collect()] == [True] * 3
    assert not any(f.exists() for f in files)


def test_upload_stream_takes_files_as_they_come(spark, tmp_path):
    folder, _, table = landed(spark, tmp_path)
    out, work = str(tmp_path / "out"), str(tmp_path / "work")

    def run():
        jobs.upload_stream(spark, str(folder), out, table, "r", "h", work, at=at(), every=None).awaitTermination()

    run()
    assert imported(spark, out) == APP + WEB
    late = folder / "web_13_hr_2014010203.txt"
    late.write_text("late\n")
    table.mark_run(spark.createDataFrame([("r", late.as_uri())], "ds string, id string"), at(), "run-1")
    run()
    assert imported(spark, out)[-1][-1] == "late" and len(imported(spark, out)) == 4
    waiting = g.replay_run(table.state(), "r").collect()
    assert [r["ids"].rsplit("/", 1)[1] for r in waiting] == ["gone_1_hr_2014010205.txt"]


@pytest.mark.parametrize("delete", [False, True])
def test_a_file_seen_before_its_ledger_row_is_imported_later(spark, tmp_path, delete):
    folder, _, table = landed(spark, tmp_path)
    early = folder / "web_14_hr_2014010203.txt"
    early.write_text("early\n")
    out, work = str(tmp_path / "out"), str(tmp_path / "work")

    def run():
        jobs.upload_stream(spark, str(folder), out, table, "r", "h", work, at=at(), every=None, delete=delete).awaitTermination()

    run()
    assert early.exists() and "early" not in [r[-1] for r in imported(spark, out)]
    table.mark_run(spark.createDataFrame([("r", early.as_uri())], "ds string, id string"), at(), "run-2")
    run()
    assert imported(spark, out)[-1][-1] == "early" and early.exists() == (not delete)
    assert (folder / "stray_1_hr_2014010204.txt").exists()


@pytest.fixture
def records(spark, tmp_path):
    folder = str(tmp_path / "topics")
    data = [("web" if i % 3 else "app", 0, i, '{"ts": %d, "v": %d}' % (i * 60_000, i)) for i in range(300)]
    data += [("web", 1, 300, '{"broken"'), ("web", 1, 301, None), ("other", 0, 302, "text")]
    spark.createDataFrame(data, RECORDS).repartition(3).write.parquet(folder)
    return folder


def resolved(spark):
    schema = "topic string, encoder string, decoder string, time_parser string, definitions array<struct<path:array<string>,default:string>>"
    return spark.createDataFrame([("web", "json-csv", "json", "obj", [(["v"], "-"), (["no"], "-")]), ("app", "json", "json", "obj", [])], schema)


def tree(spark, out, below=""):
    read = spark.read.schema("value string, topic string, dt string, hr string").option("basePath", out).text(out + below)
    return sorted((r["topic"], r["hr"], r["value"]) for r in read.collect())


def wanted_tree():
    rows = [
        ("web", f"{i // 60:02d}", f"{i},-") if i % 3 else ("app", f"{i // 60:02d}", '{"ts":%d,"v":%d}' % (i * 60_000, i))
        for i in range(300)
    ]
    return sorted((t, f"19700101{h}", v) for t, h, v in rows)


def test_hourly_stream_equals_batch_and_restarts(spark, tmp_path, records):
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    known = ["web", "app"]

    def run(per_trigger):
        stream = topic_source.read_topic_files(spark, records, RECORDS, known, per_trigger)
        jobs.hourly_stream(stream, resolved(spark), out, work, now_ms=F.lit(0), every=None).awaitTermination()

    run(1)
    assert tree(spark, out, "/batch=*") == wanted_tree()
    run(1)  # started again with nothing new
    assert tree(spark, out, "/batch=*") == wanted_tree()
    spark.createDataFrame([("web", 0, 999, '{"ts": 0, "v": 7}')], RECORDS).write.mode("append").parquet(records)
    run(1)  # a late record goes to its own hour
    assert tree(spark, out, "/batch=*") == sorted(wanted_tree() + [("web", "1970010100", "7,-")])
    dead = spark.read.parquet(f"{out}.dead/batch=*").collect()  # the broken payload is kept as it came
    assert [(r["topic"], r["partition"], r["offset"], r["value"]) for r in dead] == [("web", 1, 300, '{"broken"')]


def test_settings_are_read_for_every_batch(spark, tmp_path, records):
    out, work, loads = str(tmp_path / "out"), str(tmp_path / "work"), []

    def load(session):
        loads.append(1)
        return resolved(session)

    stream = topic_source.read_topic_files(spark, records, RECORDS, ["web", "app"], 1)
    jobs.refresh_settings(stream, load, out, work, F.lit(0), every=None).awaitTermination()
    assert tree(spark, out, "/batch=*") == wanted_tree() and len(loads) >= 3


def test_every_rolled_file_is_tracked(spark, tmp_path, records):
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    stream = topic_source.read_topic_files(spark, records, RECORDS, per_trigger=1)
    lines = stream.select("topic", "offset", (F.col("offset") * 60_000).alias("ts_ms"), F.col("value").alias("line"))
    jobs.rolled_files(lines, out, table, "rolled", work, at(), every=None).awaitTermination()
    tracked = {r["ids"] for r in g.replay_run(table.state(), "rolled").collect()}
    assert tracked == names(spark, out, "/batch=*/topic=*/dt=*/hr=*")
    assert len(tree(spark, out, "/batch=*")) == 302


def test_each_processor_gets_its_topics(spark, tmp_path, records):
    seen = {"p": [], "q": []}
    routes = spark.createDataFrame([("web", "p"), ("app", "p"), ("other", "q")], "topic string, processor string")
    stream = topic_source.read_topic_files(spark, records, RECORDS)
    take = lambda name: lambda share, batch: seen[name].extend(r["offset"] for r in share.select("offset").collect())
    jobs.custom_processor(stream, routes, {n: take(n) for n in seen}, str(tmp_path / "w"), every=None).awaitTermination()
    assert sorted(seen["p"]) == list(range(302)) and seen["q"] == [302]


def test_messages_without_processor_are_kept_or_stop_the_job(spark, tmp_path, records):
    routes = spark.createDataFrame([("web", "p"), ("app", "unknown")], "topic string, processor string")
    stream = topic_source.read_topic_files(spark, records, RECORDS)
    taken, left = [], []
    into = lambda kept: lambda share, batch: kept.extend(r["offset"] for r in share.select("offset").collect())
    jobs.custom_processor(stream, routes, {"p": into(taken)}, str(tmp_path / "w"), every=None, unrouted=into(left)).awaitTermination()
    assert sorted(left) == [*range(0, 300, 3), 302] and len(taken) + len(left) == 303
    with pytest.raises(Exception, match="no processor"):
        jobs.custom_processor(stream, routes, {"p": into([])}, str(tmp_path / "w2"), every=None).awaitTermination()


def test_empty_files_are_listed(spark, tmp_path):
    for name, content in (("a.txt", "x"), ("b.txt", ""), ("c.log", ""), ("_d.txt", "")):
        (tmp_path / name).write_text(content)
    got = {r["path"].rsplit("/", 1)[1]: r["size"] for r in list_files(spark, str(tmp_path), "*.txt").collect()}
    assert got == {"a.txt": 1, "b.txt": 0}


def polled(spark, tmp_path, number, **options):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    got = jobs.poll_files(spark, str(tmp_path / "grow"), str(tmp_path / "work"), table, "n", number, at=at(), **options)
    return [line for r in got.orderBy("file", "start").collect() for line in r["lines"]]


def test_a_line_cut_by_a_poll_is_read_whole_later(spark, tmp_path):
    (tmp_path / "grow").mkdir()
    file = tmp_path / "grow" / "f.txt"
    file.write_text("one\ntwo\nthr")
    assert polled(spark, tmp_path, 0) == ["one", "two"]
    assert polled(spark, tmp_path, 1) == []
    file.write_text("one\ntwo\nthree\nfour\nfi")
    assert polled(spark, tmp_path, 2) == ["three", "four"]
    assert polled(spark, tmp_path, 2) == ["three", "four"]  # the same poll again
    assert polled(spark, tmp_path, 3, closed=True) == ["fi"]
    file.chmod(0)  # a finished file is not opened
    (tmp_path / "grow" / "g.txt").write_text("new\n")
    assert polled(spark, tmp_path, 4) == ["new"]


def test_open_ranges_come_again_at_a_start(spark, tmp_path):
    (tmp_path / "grow").mkdir()
    (tmp_path / "grow" / "f.txt").write_text("one\ntwo\nthree\n")
    assert polled(spark, tmp_path, 0, batch_size=2) == ["one", "two", "three"]
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    first = g.replay_run(table.state(), "n").where(F.col("ids").endswith("\x010\x018"))
    table.mark_done(first.select("ds", F.col("ids").alias("id")), at(), "done-0")
    with (tmp_path / "grow" / "f.txt").open("a") as file:
        file.write("four\n")
    assert sorted(polled(spark, tmp_path, 1, recover=True)) == ["four", "three"]
    assert polled(spark, tmp_path, 2) == []


def test_topic_records_round_trip(spark, tmp_path, rows):
    df = rows([("test3", "hi"), ("test3", "té")], "topic string, value string")
    topic_sink.write_topic_files(df, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted(bytes(r["value"]) for r in got) == [b"hi", "té".encode()]
    options = topic_source.topic_options([], {"kafka.bootstrap.servers": "b:1"})
    assert options["subscribe"] == "test" and options["startingOffsets"] == "earliest"
    assert topic_source.topic_options(["a", "b"], {})["subscribe"] == "a,b"


def test_connector_columns_are_mapped(rows):
    df = rows([("test3", 1, 10, bytearray(b"test"), bytearray(b"test2"), dt.datetime(2024, 1, 1))], "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp")
    got = topic_source.as_messages(df).first()
    assert (got["topic"], got["partition"], got["offset"], bytes(got["value"])) == ("test3", 1, 10, b"test2")


def test_idle_files_close_when_the_watermark_passes(spark, tmp_path):
    folder, start = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    moments = [0, 30, 59, 119, 300, 1000]  # seconds; a gap of 60 closes
    spark.createDataFrame([("k", start + dt.timedelta(seconds=s)) for s in moments], "key string, ts timestamp").write.parquet(folder)
    stream = spark.readStream.schema("key string, ts timestamp").parquet(folder)
    files = rolls.idle_rolls_stream(stream, ["key"], "ts", "0 seconds", 60_000)
    out = str(tmp_path / "out")
    sink = files.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "w"))
    jobs.triggered(sink, None).start().awaitTermination()
    got = sorted((int((r["first_ts"] - start).total_seconds()), r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 3), (119, 1), (300, 1)]  # the last one is still open


def test_hourly_counts_of_stream_and_batch_agree(spark, tmp_path):
    folder, start = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    data = [("a" if i % 2 else "b", start + dt.timedelta(minutes=i)) for i in range(200)]
    spark.createDataFrame(data, "topic string, ts timestamp").write.parquet(folder)
    batch = {(r["topic"], r["hour"]): r["n"] for r in jobs.hourly_counts(spark.read.parquet(folder)).collect()}
    stream = spark.readStream.schema("topic string, ts timestamp").parquet(folder)
    query = jobs.triggered(jobs.hourly_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete"), None).start()
    query.awaitTermination()
    assert {(r["topic"], r["hour"]): r["n"] for r in spark.table("counts").collect()} == batch


def test_throughput_stream_reports_closed_windows(spark, tmp_path):
    folder, out, start = str(tmp_path / "in"), str(tmp_path / "out"), dt.datetime(2024, 1, 1)
    data = [("a", 0, "xx"), ("a", 5, "yyy"), ("b", 9, "z"), ("b", 9, None), ("b", 25, "é"), ("b", 300, "end")]
    lines = [(t, start + dt.timedelta(seconds=s), x) for t, s, x in data]
    spark.createDataFrame(lines, "topic string, ts timestamp, line string").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("topic string, ts timestamp, line string").parquet(folder)
    jobs.throughput_stream(stream, str(tmp_path / "w"), out, "10 seconds", "0 seconds", every=None).awaitTermination()
    schema = "topic string, whole boolean, window_ms bigint, n bigint, bytes bigint, n_per_sec double, bytes_per_sec double"
    got = spark.read.schema(schema).option("header", True).csv(out).collect()
    first = int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert sorted((r["topic"], r["window_ms"] - first, r["n"], r["bytes"], r["n_per_sec"]) for r in got) == [
        ("a", 0, 2, 5, 0.2), ("b", 0, 1, 1, 0.1), ("b", 20_000, 1, 2, 0.1), ("total", 0, 3, 6, 0.3), ("total", 20_000, 1, 2, 0.1),
    ]
