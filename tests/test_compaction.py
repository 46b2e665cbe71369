"""Small files of closed hours: packed, seen once at every moment, and deleted last."""

import collections
import gzip
import pathlib

import pytest
from pyspark.sql import functions as F

from millrace.sinks.text import write_hourly
from millrace.streaming import compaction as c

LINE = "topic string, offset bigint, ts_ms bigint, line string"
HOUR_MS = 1_704_067_200_000  # 2024-01-01 00:00


class Tree:
    def __init__(self, spark, folder):
        self.spark, self.out, self.batch, self.offset, self.sent = spark, f"{folder}/out", 0, 0, []

    def write(self, **texts):
        """one micro-batch: lines by ``topic__hour``."""
        rows = []
        for key, lines in texts.items():
            topic, hour = key.split("__")
            for line in lines:
                rows.append((topic.replace("COLON", ":"), self.offset, HOUR_MS + int(hour) * 3_600_000, line))
                self.offset += 1
        self.sent += [(t, line) for t, _, _, line in rows]
        frame = self.spark.createDataFrame(rows, LINE)
        write_hourly(frame, f"{self.out}/batch={self.batch}", mode="overwrite", salt="offset", salts=4)
        self.batch += 1

    def fill(self, batches=5, hours=(0, 1)):
        for b in range(batches):
            self.write(**{f"a__{h}": [f"{b}-{h}-{i}" for i in range(6)] for h in hours})

    def seen(self):
        return sorted((r["topic"], r["value"]) for r in c.hour_lines(self.spark, self.out).collect())

    def check(self):
        assert self.seen() == sorted(self.sent)

    def files(self, **how):
        rows = c.hour_files(self.spark, self.out, **how).collect()
        return collections.Counter((r["topic"], r["hr"]) for r in rows)


@pytest.fixture
def tree(spark, tmp_path):
    return Tree(spark, str(tmp_path))


H0, H1, H2 = "2024010100", "2024010101", "2024010102"


def test_closed_hours_are_packed_and_open_ones_and_the_last_batch_are_left(spark, tree):
    tree.fill()
    before = tree.files()
    c.compact_hours(spark, tree.out, 0, before=H1)
    after = tree.files()
    last = len(list(pathlib.Path(f"{tree.out}/batch=4/topic=a/dt=20240101/hr={H0}").glob("part*")))
    assert after[("a", H1)] == before[("a", H1)] >= 5
    assert after[("a", H0)] == 1 + last and tree.files(newest=False)[("a", H0)] == 1
    tree.check()
    c.compact_hours(spark, tree.out, 1, before=H2, newest=True)
    assert tree.files() == {("a", H0): 1, ("a", H1): 1}
    tree.check()
    # nothing is left of the batches but the last, whose folder the stream may still replace
    assert [p.name for p in pathlib.Path(tree.out).iterdir()] == ["batch=4"]
    assert not list(pathlib.Path(tree.out).rglob("part*"))


def test_bins_have_the_target_size_and_large_files_stay(spark, tree, rows):
    size = [(f"/x/batch=0/{i:03d}", s, "a", "d", "h", ".txt", 0) for i, s in enumerate([30] * 40 + [100, 250])]
    other = [("/x/batch=0/z", 5, "b", "d", "h", ".txt", 0), ("/x/batch=0/y", 5, "a", "d", "h", ".txt.gz", 0)]
    plan = c.packed(rows(size + other, f"{c.DONE}, batch bigint"), target_bytes=100)
    bins = collections.defaultdict(list)
    for r in plan.collect():
        bins[(r["topic"], r["suffix"], r["bin"])].append(r["size"])
    assert {k[:2] for k in bins} == {("a", ".txt")}  # a file alone in its bin is not written again
    assert sum(map(len, bins.values())) == 40 and all(sum(b) < 200 for b in bins.values())
    assert len(bins) + 2 <= -(-sum(s for _, s, *_ in size) // 100) + 1
    few = c.packed(rows(size, f"{c.DONE}, batch bigint"), target_bytes=100_000, max_files=10)
    assert few.groupBy("bin").count().agg(F.max("count")).first()[0] == 10


def test_late_lines_join_the_bin_of_their_hour(spark, tree):
    tree.fill()
    c.compact_hours(spark, tree.out, 0, before=H1)
    tree.write(a__0=["late"])
    tree.write(a__2=["new"])
    c.compact_hours(spark, tree.out, 1, before=H1)
    assert tree.files(newest=False)[("a", H0)] == 1
    tree.check()
    # the bins of the first run are gone as well
    assert not list(pathlib.Path(f"{tree.out}.compacted/files/run=0").rglob("bin*.gz"))


def test_lines_are_seen_once_between_the_end_of_a_run_and_the_deletion(spark, tree):
    tree.fill()
    c.compact_hours(spark, tree.out, 0, before=H2, delete=False)
    assert len(list(pathlib.Path(tree.out).rglob("part*.gz"))) >= 10
    tree.check()
    tree.write(a__0=["late"])
    c.compact_hours(spark, tree.out, 1, before=H2, newest=True, delete=False)
    tree.check()
    assert sum(tree.files().values()) == 2
    c.delete_replaced(spark, tree.out)
    tree.check()
    assert not list(pathlib.Path(tree.out).rglob("part*.gz"))


def test_a_table_of_replaced_files_beyond_the_broadcast_limit_gives_the_same(spark, tree, no_broadcast):
    tree.fill(batches=2)
    c.compact_hours(spark, tree.out, 0, before=H2, newest=True, delete=False)
    tree.check()


def test_a_stopped_run_is_not_seen_and_done_again(spark, tree, monkeypatch):
    tree.fill()
    real = c.joined_files

    def stops(plan, folder):
        real(plan, folder).collect()  # all bins are written, but the run does not end
        raise KeyboardInterrupt

    monkeypatch.setattr(c, "joined_files", stops)
    with pytest.raises(KeyboardInterrupt):
        c.compact_hours(spark, tree.out, 0, before=H2)
    tree.check()
    monkeypatch.setattr(c, "joined_files", real)
    tree.write(a__0=["more"])
    c.compact_hours(spark, tree.out, 0, before=H2, newest=True)
    tree.check()
    assert tree.files() == {("a", H0): 1, ("a", H1): 1}
    c.compact_hours(spark, tree.out, 0, before=H2)  # a run that is done is not done again
    tree.check()


def test_a_run_stopped_between_its_end_and_the_deletion_deletes_when_repeated(spark, tree):
    tree.fill(batches=2)
    c.compact_hours(spark, tree.out, 0, before=H2, newest=True, delete=False)
    c.compact_hours(spark, tree.out, 0, before=H2, newest=True)
    tree.check()
    assert not list(pathlib.Path(tree.out).rglob("part*.gz"))


def test_topics_whose_folders_are_escaped(spark, tree):
    for b in range(3):
        tree.write(**{"xCOLONy z+%__0": [f"{b}{i}" for i in range(8)]})
    c.compact_hours(spark, tree.out, 0, before=H1, newest=True, delete=False)
    tree.check()
    c.delete_replaced(spark, tree.out)
    tree.check()
    assert not list(pathlib.Path(tree.out).rglob("part*.gz")) and sum(tree.files().values()) == 1


def test_bins_hold_the_bytes_of_their_files_in_order(spark, tree):
    tree.fill(batches=3, hours=(0,))
    wanted = b"".join(
        gzip.decompress(p.read_bytes()) for b in range(3) for p in sorted(pathlib.Path(f"{tree.out}/batch={b}").rglob("part*.gz"))
    )
    c.compact_hours(spark, tree.out, 0, before=H1, newest=True)
    (made,) = pathlib.Path(f"{tree.out}.compacted/files").rglob("bin*.gz")
    assert gzip.decompress(made.read_bytes()) == wanted


def test_nothing_to_pack(spark, tree):
    assert tree.seen() == []
    c.compact_hours(spark, tree.out, 0, before=H1)
    assert tree.seen() == []
    tree.write(a__0=["one"])
    c.compact_hours(spark, tree.out, 1, before=H1, newest=True)
    c.compact_hours(spark, tree.out, 2, before=H1, newest=True)
    tree.check()
    assert tree.files() == {("a", H0): 1}


def test_hours_are_packed_as_the_watermark_passes_them(spark, tree, tmp_path):
    def run():
        lines = spark.readStream.schema("topic string, ts timestamp").parquet(str(tmp_path / "in"))
        c.compaction_stream(lines, tree.out, str(tmp_path / "state"), late="10 minutes", every=None).awaitTermination()

    def arrive(*minutes):
        times = [(f"a", m) for m in minutes]
        frame = spark.createDataFrame(times, "topic string, m int")
        at = F.timestamp_millis(F.lit(HOUR_MS) + F.col("m") * 60_000)
        frame.select("topic", at.alias("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    tree.fill(batches=3, hours=(0, 1, 2))
    many = tree.files(newest=False)
    arrive(5, 59)
    run()
    assert tree.files(newest=False) == many
    arrive(69)  # 01:09, the hour closes at 01:10
    run()
    assert tree.files(newest=False) == many
    arrive(131)  # 02:11 closes two hours
    run()
    packed = tree.files(newest=False)
    assert packed[("a", H0)] == packed[("a", H1)] == 1 and packed[("a", H2)] == many[("a", H2)]
    tree.check()


def test_the_query_lands_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    from millrace.plans import jobs as plans

    monkeypatch.setattr(plans, "FILE_ROWS", 50)
    monkeypatch.setattr(plans, "new_folder", lambda session, name: str(tmp_path / name))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(400)
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = plans.compact_hours(spark, str(tmp_path))
    rows = spark.read.parquet(str(tmp_path / "topics")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in rows) == 400 and len(rows) == 9 and max(r["count"] for r in rows) < 100
    hours = plans.processed(spark, str(tmp_path)).count()
    assert got.count() == hours and not got.where("not packed").count()
