import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import files as f
from millrace.operators.ledger import LedgerTable
from millrace.sources.lines import list_files, read_lines, read_placed_lines
from millrace.streaming.jobs import poll_files


@pytest.fixture
def small_splits(spark):
    """Read text in parts of a few hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def brute_lines(raw: bytes):
    """(start, end, text) of every line."""
    mark = 3 if raw.startswith(b"\xef\xbb\xbf") else 0
    at, out = mark, []
    parts = raw[mark:].split(b"\n")
    if parts[-1] == b"":
        parts.pop()
    for part in parts:
        end = min(at + len(part) + 1, len(raw))
        out.append((at, end, part.decode()))
        at += len(part) + 1
    return out


def contents(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé \r") for _ in range(rng.randrange(0, 40)))
    big = "\n".join(word() for _ in range(400))
    return {
        "big.txt": big.encode(),  # no newline at the end
        "small.txt": b"one\n\nthree\r\n",
        "mark.txt": b"\xef\xbb\xbf" + big[:3000].encode() + b"\n",
        "mark2.txt": b"\xef\xbb\xbfabc\ndef",
        "empty.txt": b"",
        "one.log": b"x",
    }


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for name, raw in contents().items():
        (path / name).write_bytes(raw)
    return path


def name_of(file):
    return file.rsplit("/", 1)[1]


def test_positions_of_real_files_in_many_parts(spark, folder, small_splits):
    lines = read_placed_lines(spark, str(folder))
    assert lines.select("file", "block").distinct().count() > 20
    placed = f.line_offsets(lines).collect()
    for name, raw in contents().items():
        mine = sorted((r for r in placed if name_of(r["file"]) == name), key=lambda r: r["line_no"])
        assert [(r["start"], r["end"], r["value"]) for r in mine] == brute_lines(raw), name
        assert [r["line_no"] for r in mine] == list(range(len(mine)))


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("share", [0, 0.3, 0.999, 1])
def test_only_lines_after_the_position(spark, folder, small_splits, share, closed):
    lines = read_placed_lines(spark, str(folder))
    files = list_files(spark, str(folder))
    # the listing and the reader name files alike
    assert {r[0] for r in lines.select("file").distinct().collect()} <= {r["path"] for r in files.collect()}
    positions = files.select(F.col("path").alias("file"), F.floor(F.col("size") * share).alias("sent_size"))
    got = f.read_new_lines(lines, positions, closed).collect()
    for name, raw in contents().items():
        mine = sorted((r["start"], r["end"], r["value"]) for r in got if name_of(r["file"]) == name)
        whole = lambda b: closed or raw[b[1] - 1 : b[1]] == b"\n"
        assert mine == [b for b in brute_lines(raw) if b[0] >= int(len(raw) * share) and whole(b)]


def test_files_of_two_name_spaces_are_told_apart(rows):
    listing = rows([("a", "f", 10), ("b", "f", 10)], "ns string, file string, size bigint")
    steps = rows([("a", "f", 4), ("a", "f", 6), ("b", "f", 3)], "ns string, file string, delta bigint")
    positions = f.sent_size(steps, listing)
    progress = f.file_progress(listing, positions)
    assert sorted(map(tuple, progress.select("ns", "sent_size").collect())) == [("a", 10), ("b", 3)]
    tracked = rows([("a", "f", 0, 4, "done"), ("b", "f", 0, 3, "run")], "ns string, file string, start bigint, end bigint, status string")
    assert [r["ns"] for r in f.deletable_files(progress, tracked).collect()] == ["a"]
    assert [r["ns"] for r in f.recoverable_ranges(tracked, listing.where("ns = 'b'")).collect()] == ["b"]
    assert f.recoverable_ranges(tracked, listing.where("ns = 'a'")).count() == 0


def test_batches_are_exact_and_contiguous(spark, folder, small_splits):
    batches = f.batch_lines(f.line_offsets(read_placed_lines(spark, str(folder))), 50).collect()
    for name, raw in contents().items():
        mine = sorted((r for r in batches if name_of(r["file"]) == name), key=lambda r: r["batch"])
        assert [x for r in mine for x in r["lines"]] == [b[2] for b in brute_lines(raw)]
        assert all(a["end"] == b["start"] for a, b in zip(mine, mine[1:]))
        assert all(r["n"] == 50 for r in mine[:-1])


@pytest.mark.parametrize("cell, span", [(16, 4), (16, 4096), (1000, 2), (1 << 20, 4096)])
def test_ranges_match_brute_force_in_any_cells(spark, rows, folder, monkeypatch, cell, span):
    monkeypatch.setattr(f, "SPAN_CELLS", span)
    placed = f.line_offsets(read_placed_lines(spark, str(folder)))
    uri = {name_of(r[0]): r[0] for r in placed.select("file").distinct().collect()}
    big = brute_lines(contents()["big.txt"])
    ranges = [(uri["big.txt"], big[a][0], big[b][1]) for a, b in ((0, 0), (10, 120), (100, 110), (398, 399))]
    ranges += [(uri["small.txt"], 0, 4), (uri["small.txt"], 4, 4)]
    got = f.read_ranges(placed, rows(ranges, "file string, start bigint, end bigint"), cell).collect()
    want = [
        (file, lo, hi, s, e)
        for file, lo, hi in ranges
        for s, e, _ in brute_lines(contents()[name_of(file)])
        if lo <= s and e <= hi and hi > lo
    ]
    assert sorted((r["file"], r["range_start"], r["range_end"], r["start"], r["end"]) for r in got) == sorted(want)


def test_lists_and_filters(spark, folder):
    files = list_files(spark, str(folder), "*.txt")
    assert {name_of(r["path"]): r["size"] for r in files.collect()} == {
        n: len(c) for n, c in contents().items() if n.endswith(".txt")
    }
    logs = f.filter_files(list_files(spark, str(folder)), lambda p: p.endswith(".log"))
    assert [name_of(r["path"]) for r in logs.collect()] == ["one.log"]
    assert read_lines(spark, str(folder / "small.txt")).count() == 3


@pytest.fixture
def progress(rows):
    return rows([("new", 10, 0), ("half", 10, 5), ("sent", 10, 10), ("cut", 5, 9)], "file string, size bigint, sent_size bigint")


def test_done_and_not_done(rows, progress):
    assert sorted(r["file"] for r in f.done_files(progress).collect()) == ["cut", "sent"]
    assert sorted(r["file"] for r in f.not_done_files(progress).collect()) == ["cut", "half", "new"]
    recovery = rows([("sent",), ("half",)], "file string")
    names = f.files_to_read(progress, recovery, lambda n: n != "new").collect()
    assert sorted(r["file"] for r in names) == ["cut", "half", "sent"]


def test_position_is_the_sum_of_increments(rows):
    moves = rows([("n", "a", 4), ("n", "a", 6), ("n", "a", -1), ("n", "b", 100)], "ns string, file string, delta bigint")
    sizes = rows([("b", 7)], "file string, size bigint")
    assert {r["file"]: r["sent_size"] for r in f.sent_size(moves).collect()} == {"a": 9, "b": 100}
    assert {r["file"]: r["sent_size"] for r in f.sent_size(moves, sizes).collect()} == {"a": 9, "b": 7}


def test_files_are_deleted_only_when_sent_and_done(rows, progress):
    tracked = rows(
        [("n", "sent", 0, 5, "done"), ("n", "sent", 5, 10, "done"), ("n", "cut", 0, 5, "done"), ("n", "cut", 5, 9, "run"), ("n", "half", 0, 5, "done")],
        "ns string, file string, start bigint, end bigint, status string",
    )
    assert [r["file"] for r in f.deletable_files(progress, tracked).collect()] == ["sent"]
    left = f.recoverable_ranges(tracked, progress).collect()
    assert [(r["file"], r["start"], r["end"]) for r in left] == [("cut", 5, 9)]
    grouped = f.ranges_by_file(tracked, cell=5).collect()
    assert sum(r["n"] for r in grouped) == 5 and max(r["n"] for r in grouped) == 1


def lines_of(batches):
    return sorted(x for r in batches.collect() for x in r["lines"])


def test_polling_a_growing_file_reads_each_line_once(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    file = folder / "a.txt"
    table = LedgerTable(spark, str(tmp_path / "ledger"))

    def poll(n):
        return poll_files(spark, str(folder), str(work), table, "ns", n, batch_size=2)

    file.write_bytes(b"1\n2\n3\n")
    assert lines_of(poll(0)) == ["1", "2", "3"]
    with file.open("ab") as out:
        out.write(b"4\n5\n")
    assert lines_of(poll(1)) == ["4", "5"]
    assert lines_of(poll(2)) == []
    assert f.tracked_ranges(table.state()).count() == 4


@pytest.mark.parametrize("stop_before", ["ledger", "position"])
def test_a_poll_that_was_stopped_is_repeated_whole(spark, tmp_path, monkeypatch, stop_before):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    (folder / "a.txt").write_bytes(b"1\n2\n3\n")
    table = LedgerTable(spark, str(tmp_path / "ledger"))
    with monkeypatch.context() as patch:
        real = LedgerTable.mark_run

        def stop(self, *args):
            if stop_before == "position":
                real(self, *args)
            raise KeyboardInterrupt

        patch.setattr(LedgerTable, "mark_run", stop)
        with pytest.raises(KeyboardInterrupt):
            poll_files(spark, str(folder), str(work), table, "ns", 0)
    again = poll_files(spark, str(folder), str(work), table, "ns", 0)
    assert lines_of(again) == ["1", "2", "3"]
    assert lines_of(poll_files(spark, str(folder), str(work), table, "ns", 1)) == []
    assert f.tracked_ranges(table.state()).count() == 1


def test_a_part_of_a_file_is_placed_in_bounded_pieces(spark):
    """A part has as many lines as the reader's split holds; a task should not hold them all."""
    n = 3 * (1 << 16) + 5
    seq = F.col("id") + (1 << 33)  # as monotonically_increasing_id gives it in the second task
    size = F.lit(2 * n).cast("bigint").alias("file_size")
    lines = spark.range(n).select(
        F.lit("f").alias("file"), size, F.lit(0).cast("bigint").alias("block"), seq.alias("seq"), F.lit(2).cast("bigint").alias("bytes"),
        F.lit("x").alias("value"), "id",
    )
    assert f.line_totals(lines).count() == 4
    assert f.line_offsets(lines).where("start = 2 * id and end = start + 2 and line_no = id").count() == n
    sent = spark.createDataFrame([("f", 2 * (1 << 16) + 10)], "file string, sent_size bigint")
    assert f.read_new_lines(lines, sent).where("start = 2 * id and line_no = id").count() == n - (1 << 16) - 5
