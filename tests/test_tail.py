"""Growing files as a stream: what is read, and from where."""

import random

import pyarrow as pa
import pytest

from millrace.operators import ledger as g
from millrace.sources import tail
from millrace.streaming import jobs


def reader(folder, **options):
    return tail.TailReader({"path": str(folder), **{k: str(v) for k, v in options.items()}})


def read(r, start, end):
    out = []
    for part in r.partitions(start, end):
        for batch in r.read(part):
            assert isinstance(batch, pa.RecordBatch)
            out += batch.to_pylist()
    return out


class Counted:
    def __init__(self, source, seen):
        self.source, self.seen = source, seen

    def seek(self, at):
        self.source.seek(at)

    def read(self, n):
        data = self.source.read(n)
        self.seen.append(len(data))
        return data


@pytest.mark.parametrize("split", [1, 7, 64, 1 << 20])
def test_every_line_once_wherever_polls_and_splits_cut(tmp_path, split):
    chance = random.Random(split)
    whole = "".join(chance.choice(["", "é", "line", "x" * 40, "\r"]) + "\n" for _ in range(80)).encode()
    path, r = tmp_path / "a.txt", reader(tmp_path, splitBytes=split, splitbytes=split)
    at, rows, before = 0, [], r.initialOffset()
    while at < len(whole):
        step = chance.randint(1, 90)
        with open(path, "ab") as out:
            out.write(whole[at : at + step])
        at += step
        now = r.latestOffset()
        rows += read(r, before, now)
        before = now
    assert [row["value"] for row in rows] == whole.decode().split("\n")[:-1]
    assert all(whole[row["start"] : row["end"]].decode() == row["value"] + "\n" for row in rows)


def test_small_ranges_share_a_task(tmp_path):
    r = reader(tmp_path, splitbytes=64)
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_bytes(b"0123456789\n" * 1000)
    now = r.latestOffset()
    (part,) = r.partitions({}, now)  # not one for each of 344 ranges
    assert len(part.ranges) == 344 and max(p.end - p.start for p in part.ranges) == 64
    rows = read(r, {}, now)
    assert len(rows) == 2000 and len({(row["file"], row["range_start"]) for row in rows}) == 344
    assert [len(getattr(p, "ranges", [p])) for p in tail.dealt(part.ranges[:5], 128)] == [2, 2, 1]


def test_only_appended_bytes_are_read(tmp_path):
    path, r, seen = tmp_path / "a.txt", reader(tmp_path), []
    path.write_bytes(b"0123456789\n" * 1_000_000)
    first = r.latestOffset()
    with open(path, "ab") as out:
        out.write(b"new\n")
    (part,) = r.partitions(first, r.latestOffset())
    with open(path, "rb") as source:
        lines = list(tail.lines_of(Counted(source, seen), part))
    assert [line for _, some in lines for line in some] == [b"new"] and lines[0][0] == 11_000_000
    assert sum(seen) <= tail.LOOK_BACK + 4


def test_last_lines_marks_odd_bytes_and_files_that_shrink(tmp_path):
    (tmp_path / "a.txt").write_bytes(b"\xef\xbb\xbfhead\nbad \xff byte\nopen")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / ".hidden.txt").write_bytes(b"no\n")
    (tmp_path / "b.log").write_bytes(b"other\n")
    r = reader(tmp_path, pattern="*.txt")
    now = r.latestOffset()
    assert len(now) == 2
    assert [(x["value"], x["start"], x["seq"]) for x in read(r, {}, now)] == [("head", 0, 0), ("bad � byte", 8, 1)]
    closed = reader(tmp_path, pattern="*.txt", closed="true")
    assert [(x["value"], x["end"]) for x in read(closed, {}, now)][-1] == ("open", 23)
    (tmp_path / "a.txt").write_bytes(b"anew\n")
    assert [x["value"] for x in read(r, now, r.latestOffset())] == ["anew"]
    (tmp_path / "a.txt").unlink()
    assert read(r, now, r.latestOffset()) == []


def test_no_folder_yet(tmp_path):
    assert reader(tmp_path / "later").latestOffset() == {}


def test_a_stream_tracks_batches_once(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    go = lambda state: jobs.tail_stream(spark, str(landed), str(tmp_path / "work"), table, "ns", str(tmp_path / state), batch_size=3, every=None).awaitTermination()
    (landed / "a.txt").write_text("".join(f"{k}\n" for k in range(10)) + "half")
    go("one")
    with open(landed / "a.txt", "a") as out:
        out.write(" a line\nx\n")
    go("one")
    go("one")
    rows = spark.read.parquet(f"{tmp_path}/work/lines/batch=*").orderBy("start").collect()
    assert [line for r in rows for line in r["lines"]] == [*map(str, range(10)), "half a line", "x"]
    assert [r["n"] for r in rows] == [3, 3, 3, 1, 2]
    assert table.state().where("status = 'run'").count() == 5
    go("two")  # the first batch again without its checkpoint: nothing is tracked twice
    assert table.state().count() == 5
