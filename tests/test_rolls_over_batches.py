"""Files that go on over micro-batches, and imports that lose nothing."""

import datetime as dt
import gzip

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger as g
from millrace.sinks import imports
from millrace.streaming import jobs, rolls

LINE = "topic string, partition int, offset bigint, ts_ms bigint, line string"
HOUR_MS = 1_704_067_200_000  # 2024-01-01


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def clock(batch):
    return dt.datetime(2024, 1, 1, 0, batch, tzinfo=dt.timezone.utc)


class Rolling:
    def __init__(self, spark, folder, roll_bytes=100, idle_ms=120_000):
        self.spark, self.folder, self.roll_bytes, self.idle_ms, self.offset = spark, folder, roll_bytes, idle_ms, 0
        self.ledger = g.LedgerTable(spark, f"{folder}/ledger")

    def batch(self, **lines):
        rows = []
        for topic, texts in lines.items():
            for text in texts:
                rows.append((topic, 0, self.offset, HOUR_MS, text))
                self.offset += 1
        self.spark.createDataFrame(rows, LINE).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        self.write()
        self.close()

    def write(self, state="c1"):
        stream = self.spark.readStream.schema(LINE).parquet(f"{self.folder}/in")
        rolls.write_segments(stream, f"{self.folder}/work", f"{self.folder}/{state}", self.roll_bytes, clock, every=None).awaitTermination()

    def close(self, state="c2"):
        rolls.close_rolls(
            self.spark, f"{self.folder}/work", f"{self.folder}/out", self.ledger, "rolled", f"{self.folder}/{state}",
            self.roll_bytes, self.idle_ms, at(), every=None,
        ).awaitTermination()

    def closed(self):
        """Lines of each tracked file, read from it."""
        out = {}
        for unit in g.deserialized(self.ledger.state()).where("status = 'run'").collect():
            path = unit["ids"].removeprefix("file:").replace("//", "/")
            out[path.split("name=")[1].split("/")[0]] = gzip.open(path, "rt").read().splitlines()
        return out


def test_a_file_goes_on_over_five_batches_and_closes_by_size_or_idle_time(spark, tmp_path):
    r = Rolling(spark, str(tmp_path))
    for k in range(5):
        r.batch(a=[f"{k}{i}" + "x" * 22 for i in range(1)], **({"b": ["y"]} if k == 0 else {}))  # a: 25 bytes a batch
        names = set(r.closed())
        if k < 2:
            assert not names
    files = r.closed()
    # a had its 100 bytes in batch 3, b was idle for two minutes in batch 2; batch 4 of a is open
    assert files == {"a_0-0_hr_2024010100": [f"{k}0" + "x" * 22 for k in range(4)], "b_0-0_hr_2024010100": ["y"]}
    r.batch(c=["z"])
    r.batch(c=["z"])
    assert set(r.closed()) == {"a_0-0_hr_2024010100", "b_0-0_hr_2024010100", "a_4-0_hr_2024010100"}
    left = sorted(p.parent.name + p.parts[-4] for p in (tmp_path / "work/segments").rglob("*.txt.gz"))
    assert len(left) == 2  # only those of c, which is open


def test_a_large_batch_makes_files_of_about_the_roll_size(spark, tmp_path):
    r = Rolling(spark, str(tmp_path), roll_bytes=1000)
    r.batch(hot=[f"{i:08d}" for i in range(1000)])  # 9 bytes each
    sizes = [sum(len(line) + 1 for line in lines) for lines in r.closed().values()]
    assert len(sizes) == 8 and all(1000 <= s < 1000 + 1000 // rolls.SEGMENTS_PER_ROLL + 9 for s in sizes)
    got = [line for _, lines in sorted(r.closed().items(), key=lambda kv: int(kv[0].split("-")[1].split("_")[0])) for line in lines]
    assert got == [f"{i:08d}" for i in range(len(got))]


def test_small_segments_share_a_file_that_goes_with_the_last_of_them(spark, tmp_path):
    r = Rolling(spark, str(tmp_path), roll_bytes=80)  # segments of 10 bytes
    lines = [f"{i:08d}" for i in range(100)] + ["a\tb\nc\td", "", "12345678", "z"]
    r.batch(hot=lines)
    segments = lambda: len(list((tmp_path / "work/segments").rglob("*.txt.gz")))
    assert spark.read.parquet(f"{tmp_path}/work/manifest/batch=0").count() > 80 and segments() == 1  # some of them are open
    r.batch(hot=["x" * 100])
    r.batch(cold=["y"])
    r.batch(cold=["y"])
    first = lambda kv: tuple(map(int, kv[0].split("_")[1].split("-")))
    got = [line for name, found in sorted(r.closed().items(), key=first) if name.startswith("hot") for line in found]
    assert got == [*lines[:100], "a\tb", "c\td", "", "12345678", "z", "x" * 100] and segments() == 2  # those of cold


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    r = Rolling(spark, str(tmp_path), roll_bytes=10)
    r.batch(a=["x" * 20], b=["y" * 20])
    before = r.closed()
    r.write("again-1")  # the same batch id without its checkpoint, as after a stop before its commit
    r.close("again-2")
    assert r.closed() == before and len(before) == 2
    # nor does it after the files were imported and deleted
    imports.import_files(
        spark, g.replay_run(r.ledger.state(), "rolled").select("ds", F.col("ids").alias("id")), f"{tmp_path}/tree", r.ledger, "0", "h", at(),
        landed=f"{tmp_path}/out/batch=*/name=*", delete=True, name_of=rolls.folder_name,
    )
    r.close("again-3")
    assert {u["status"] for u in r.ledger.state().collect()} == {"done"}
    assert spark.read.option("basePath", f"{tmp_path}/tree").text(f"{tmp_path}/tree/batch=*").count() == 2


def test_moments_rise_though_the_clock_goes_back(spark, tmp_path):
    r = Rolling(spark, str(tmp_path))
    r.batch(a=["1"])
    frames = spark.read.schema(rolls.SEGMENT).parquet(f"{tmp_path}/work/manifest/batch=0")
    last = frames.agg(F.max("at")).first()[0]
    late = rolls._moment(spark, f"{tmp_path}/work", 1, lambda batch: dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc))
    assert late.timestamp() > last.replace(tzinfo=dt.timezone.utc).timestamp()


class Held:
    """A state as the closing function sees it."""

    def __init__(self):
        self.value, self.hasTimedOut, self.timer = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        self.timer = ms


def test_the_state_of_a_key():
    close, state, key = rolls.closing(100, 1000), Held(), ("t", "20240101", "2024010100")
    feed = lambda *rows: [r for f in close(key, iter([pd.DataFrame(rows, columns=["batch", "seg", "n", "bytes", "at_ms"])]), state) for r in f.to_dict("records")]
    assert feed((0, 0, 1, 60, 5)) == [] and state.timer == 1004
    assert [(r["name"], r["reason"], r["segments"], r["bytes"]) for r in feed((1, 1, 1, 1, 600), (1, 0, 1, 60, 600))] == [("0-0", "size", "0-0 1-0", 120)]
    assert state.value == ("1-1", 1, 1, 600, "1-1")
    assert [(r["name"], r["reason"]) for r in feed((2, 0, 1, 5, 1600))] == [("1-1", "idle")]
    state.hasTimedOut = True
    assert [(r["name"], r["reason"], r["n"]) for r in feed()] == [("2-0", "idle", 1)] and not state.exists
    assert list(close((None, None, None), iter([]), Held())) == []


# --- imports -------------------------------------------------------------------------------


def units_of(spark, folder, table, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / name).write_text(f"{name}\n")
    units = spark.createDataFrame([("r", f"file://{folder}/{n}") for n in names], "ds string, id string")
    table.mark_run(units, at(), f"run-{names[0]}")
    return units


def states(table):
    return {r["ids"].rsplit("/", 1)[1]: r["status"] for r in g.deserialized(table.state()).collect()}


@pytest.mark.parametrize("delete", [False, True])
def test_files_without_a_place_are_kept(spark, tmp_path, delete):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    landed = tmp_path / "landed"
    for batch, names in enumerate([["notes.txt", "readme"], ["web_1_hr_2014010203.txt"]]):
        units_of(spark, landed, table, names)
        units = g.replay_run(table.state(), "r").select("ds", F.col("ids").alias("id"))
        imports.import_files(spark, units, str(tmp_path / "out"), table, str(batch), "h", at(), landed=str(landed), delete=delete)
    assert states(table) == {"notes.txt": "run", "readme": "run", "web_1_hr_2014010203.txt": "done"}
    assert {p.name for p in landed.iterdir() if not p.name.startswith(".")} >= {"notes.txt", "readme"}
    assert (landed / "web_1_hr_2014010203.txt").exists() != delete
    kept = spark.read.parquet(f"{tmp_path}/out.quarantine/batch=*")
    assert {r["name"] for r in kept.collect()} == {"notes.txt", "readme"}
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out/batch=*").collect()] == ["web_1_hr_2014010203.txt"]


def test_one_call_imports_all_files_portion_by_portion(spark, tmp_path, monkeypatch):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    names = [f"web_{k:02d}_hr_20140102{k % 24:02d}.txt" for k in range(25)]
    units = units_of(spark, tmp_path / "landed", table, names)
    go = lambda: imports.import_files(spark, units, str(tmp_path / "out"), table, "0", "h", at(), delete=True, max_files=10)
    marked, calls = g.LedgerTable.mark_done, []

    def stop_at_second(self, *a):
        calls.append(a)
        if len(calls) == 2:
            raise KeyboardInterrupt
        marked(self, *a)

    with monkeypatch.context() as patch:
        patch.setattr(g.LedgerTable, "mark_done", stop_at_second)
        with pytest.raises(KeyboardInterrupt):
            go()
    for _ in range(2):
        go()
    assert set(states(table).values()) == {"done"} and len(states(table)) == 25
    assert sorted(r["value"] for r in spark.read.option("basePath", f"{tmp_path}/out").text(f"{tmp_path}/out/batch=*").collect()) == names
    assert not [p for p in (tmp_path / "landed").iterdir() if p.suffix == ".txt"]


def test_each_type_may_have_directories_of_its_own(spark, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    units = units_of(spark, tmp_path / "landed", table, ["2014010203+web", "2014010204+app"])
    parser = lambda name: F.struct(F.split(name, r"\+")[1].alias("type"), F.lit("1").alias("id"), name.alias("date_hour"))

    def by_type(hour):
        day = F.concat(F.lit("day="), F.left(hour, F.lit(8)))
        return F.when(hour.endswith("web"), day).otherwise(F.concat(day, F.lit("/hour="), F.substring(hour, 9, 2)))

    from millrace.functions import timekeys

    directory = timekeys.partition_dir
    try:  # the hour is handed on with the name's type behind it
        imports.partition_dir = lambda hour, model, models: by_type(hour)
        imports.import_files(spark, units, str(tmp_path / "out"), table, "0", "h", at(), file_model=3, file_models={3: parser})
    finally:
        imports.partition_dir = directory
    found = {str(p.relative_to(tmp_path / "out").parent) for p in (tmp_path / "out").rglob("part-*")}
    assert found == {
        "batch=0/type=web/day=20140102/src=h-2014010203+web", "batch=0/type=app/day=20140102/hour=04/src=h-2014010204+app"
    }


def test_a_repeated_rolled_batch_after_its_upload_is_not_imported_twice(spark, tmp_path):
    lines = spark.range(10).select(
        F.lit("web").alias("topic"), F.lit(0).cast("bigint").alias("ts_ms"), F.col("id").cast("string").alias("line"), F.col("id").alias("offset")
    )
    lines.write.parquet(f"{tmp_path}/in")
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    out = str(tmp_path / "rolled")
    named = lambda path: F.concat(F.regexp_extract(path, "topic=([^/]+)", 1), F.lit("_1_hr_"), F.regexp_extract(path, "hr=([^/]+)", 1), F.lit("-"), F.element_at(F.split(path, "/"), -1))
    for turn in range(2):
        stream = spark.readStream.schema(lines.schema).parquet(f"{tmp_path}/in")
        jobs.rolled_files(stream, out, table, "r", f"{tmp_path}/check-{turn}", at(), every=None).awaitTermination()
        units = g.replay_run(table.state(), "r").select("ds", F.col("ids").alias("id"))
        imports.import_files(spark, units, f"{tmp_path}/tree", table, str(turn), "h", at(), name_of=named, delete=True)
    assert spark.read.option("basePath", f"{tmp_path}/tree").text(f"{tmp_path}/tree/batch=*").count() == 10
    assert {r["status"] for r in table.state().collect()} == {"done"}
