import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger as g

NOW = dt.datetime(2024, 1, 1)
STATE = "dsid string, status string, ts timestamp"


def at(seconds=0):
    return F.lit((NOW + dt.timedelta(seconds=seconds)).isoformat(sep=" ")).cast("timestamp")


@pytest.fixture
def hundred(rows):
    return rows([(f"ds\x01id{i}", "run", NOW) for i in range(100)] + [("ds2\x01id0", "run", NOW)], STATE)


def apply(state, events):
    return g.apply_events(state, events, at(-1_000_000))


def test_hundred_in_run(hundred):
    assert g.select_ds_messages(hundred, "ds").count() == 100


def test_half_done_leaves_half(rows, hundred):
    half = rows([("ds", f"id{i}") for i in range(50)], "ds string, id string")
    state = apply(hundred, g.mark_done(hundred, half, at(1)))
    assert g.select_ds_messages(state, "ds").count() == 50
    assert {r["status"]: r["n"] for r in g.status_counts(state, "ds").collect()} == {"run": 50, "done": 50}
    assert {r["ts"] for r in state.collect()} == {NOW}  # the time of a unit does not move


def test_expiry_leaves_none(hundred):
    assert g.expire(hundred, at(0)).count() == 0
    assert g.expire(hundred, at(-1)).count() == 101
    month = 28 * 24 * 3600
    assert g.expire_after(hundred, at(month)).count() == 0
    assert g.expire_after(hundred, at(month - 1)).count() == 101


def test_a_unit_is_run_once(rows, hundred):
    wanted = rows([("ds", "id1"), ("ds", "new"), ("ds", "new")], "ds string, id string")
    assert [r["dsid"] for r in g.mark_run(hundred, wanted, at()).collect()] == ["ds\x01new"]
    dup = {r["dsid"]: (r["n"], r["known"]) for r in g.duplicate_units(hundred, wanted).collect()}
    assert dup == {"ds\x01id1": (1, True), "ds\x01new": (2, False)}
    assert g.dedup_units(wanted).count() == 2


def test_only_running_units_become_done(rows, hundred):
    wanted = rows([("ds", "id1"), ("ds", "none")], "ds string, id string")
    assert [(r["dsid"], r["status"]) for r in g.invalid_transitions(hundred, wanted).collect()] == [("ds\x01none", None)]
    with pytest.raises(Exception, match="not in run"):
        g.mark_done(hundred, wanted, at(1), strict=True).collect()
    ok = rows([("ds", "id1")], "ds string, id string")
    state = apply(hundred, g.mark_done(hundred, ok, at(1), strict=True))
    with pytest.raises(Exception, match="not in run"):
        g.mark_done(state, ok, at(2), strict=True).collect()


def test_update_and_delete(rows, hundred):
    one = rows([("ds", "id1")], "ds string, id string")
    changed = apply(hundred, g.update_message(hundred, one, at(1), status=F.lit("held"), ts=at(5)))
    got = g.get_message(changed, "ds\x01id1").first()
    assert (got["status"], got["ts"]) == ("held", NOW + dt.timedelta(seconds=5))
    assert g.get_message(apply(hundred, g.delete_message(hundred, one, at(1))), "ds\x01id1").count() == 0


def test_done_wins_at_the_same_instant(rows):
    events = rows([("a", "done", NOW, NOW), ("a", "run", NOW, NOW)], STATE + ", at timestamp")
    assert [r["status"] for r in g.latest_state(events).collect()] == ["done"]


@pytest.mark.parametrize("top_k", [1000, 41])
def test_pages_do_not_overlap(hundred, top_k):
    ids = [r["dsid"] for r in sorted(hundred.collect())]
    first = [r["dsid"] for r in g.page(hundred, 0, 40, top_k).collect()]
    second = [r["dsid"] for r in g.page(hundred, 40, 40, top_k).collect()]
    last = [r["dsid"] for r in g.page(hundred, 80, 40, top_k).collect()]
    assert sorted(first) + sorted(second) + sorted(last) == ids


def test_select_messages_takes_sql_text(hundred):
    assert g.select_messages(hundred, "dsid like 'ds2%'").count() == 1
    assert g.select_messages(hundred).count() == 100  # one page


def test_table_survives_a_repeated_batch(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    assert table.state().count() == 0
    units = rows([("ds", str(i)) for i in range(10)], "ds string, id string")
    for _ in range(2):
        table.mark_run(units, at(0), "run-0")
    assert table.state().count() == 10 and table.events().count() == 10
    for _ in range(2):
        table.mark_done(units.where("id < 5"), at(1), "done-0")
    assert {r["status"]: r["n"] for r in g.status_counts(table.state(), "ds").collect()} == {"run": 5, "done": 5}
    assert table.events().count() == 15
    assert sorted(r["ids"] for r in g.replay_run(table.state(), "ds").collect()) == list("56789")


def test_table_expiry_writes_a_new_version(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    table.mark_run(rows([("ds", "old")], "ds string, id string"), at(0), "a")
    table.mark_run(rows([("ds", "new")], "ds string, id string"), at(100), "b")
    table.mark_done(rows([("ds", "new")], "ds string, id string"), at(101), "c")
    table.expire(at(50))
    assert [(r["dsid"], r["status"]) for r in table.state().collect()] == [("ds\x01new", "done")]
    table.mark_run(rows([("ds", "old")], "ds string, id string"), at(200), "d")
    assert table.state().count() == 2
    table.expire(at(150))
    assert [r["dsid"] for r in table.state().collect()] == ["ds\x01old"]


def test_compaction_keeps_the_state(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    table.mark_run(rows([("ds", str(i)) for i in range(4)], "ds string, id string"), at(0), "a")
    table.mark_done(rows([("ds", "1")], "ds string, id string"), at(1), "b")
    before = sorted(map(tuple, table.state().collect()))
    table.compact()
    assert sorted(map(tuple, table.state().collect())) == before and table.events().count() == 4
    table.mark_done(rows([("ds", "2")], "ds string, id string"), at(2), "b")
    assert {r["status"]: r["n"] for r in g.status_counts(table.state(), "ds").collect()} == {"run": 2, "done": 2}


def test_replay_only_of_files_that_are_there(rows, hundred):
    listing = rows([("id3",), ("id7",), ("other",)], "path string")
    got = g.processor_replay(hundred, "ds", listing).collect()
    assert sorted(r["ids"] for r in got) == ["id3", "id7"]


def test_a_removal_wins_over_run_at_the_same_instant(rows):
    events = [("a", "run", at_time(0), at_time(5)), ("a", None, at_time(0), at_time(5)), ("b", "run", at_time(0), at_time(5)), ("b", "done", at_time(0), at_time(5))]
    got = g.latest_state(rows(events, "dsid string, status string, ts timestamp, at timestamp")).collect()
    assert [(r["dsid"], r["status"]) for r in got] == [("b", "done")]


def test_a_unit_of_later_time_is_done_after_a_compaction(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    future = rows([("ds\x01u", "run", at_time(1000), at_time(0))], "dsid string, status string, ts timestamp, at timestamp")
    table.append(future, "a")
    table.compact()
    table.mark_done(rows([("ds", "u")], "ds string, id string"), at(10), "b")
    assert [(r["status"], r["ts"]) for r in table.state().collect()] == [("done", at_time(1000))]
    assert table.has("a") and table.has("b") and not table.has("c") and table.batch("b").count() == 1


def at_time(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_a_table_is_compacted_after_so_many_batches(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"), compact_every=3)
    for k in range(8):
        table.mark_run(rows([("ds", str(k))], "ds string, id string"), at(k), f"run-{k}")
        table.mark_done(rows([("ds", str(k))], "ds string, id string"), at(k), f"done-{k}")
        table.mark_done(rows([("ds", str(k))], "ds string, id string"), at(k), f"done-{k}")  # repeated
    assert {r["status"]: r["n"] for r in g.status_counts(table.state(), "ds").collect()} == {"done": 8}
    assert len(table._glob(f"v={table._version()}/batch=*/_SUCCESS")) <= 4 and table.has("run-0")


@pytest.mark.parametrize(("splits", "range_rows"), [(4, 50), (16, 60), (256, 45)])
def test_pages_are_found_by_rank_at_every_depth(spark, monkeypatch, splits, range_rows):
    monkeypatch.setattr(g, "SPLITS", splits)
    state = spark.range(3000).selectExpr("concat('d', id % 1500) AS dsid", "if(id < 1500, 'run', 'done') AS status", "timestamp_seconds(id) AS ts")
    want = [tuple(r) for r in state.select("dsid", "ts", "status").orderBy("dsid", "ts", "status").collect()]
    for start in (0, 44, 45, 777, 1499, 2960, 2990, 3000, 9000):
        got = [(r["dsid"], r["ts"], r["status"]) for r in g.page(state, start, 40, range_rows).collect()]
        assert got == want[start : start + 40]


def test_a_page_of_one_repeated_id(spark):
    state = spark.range(500).selectExpr("'same' AS dsid", "'run' AS status", "timestamp_seconds(id) AS ts")
    assert [r["ts"].second for r in g.page(state, 60, 3, 10).collect()] == [0, 1, 2]
    assert g.page(state, 500, 3, 10).count() == 0


def test_dedup_state_of_a_stream_is_bounded_by_time(spark, tmp_path):
    schema, seen = "ds string, id string, ts timestamp", []
    for hour in range(6):
        rows = [("r", f"{hour}-{k % 20}", k * 10) for k in range(100)]  # each unit five times within the hour
        units = spark.createDataFrame(rows, "ds string, id string, s int").selectExpr("ds", "id", f"timestamp_seconds({hour * 3600} + s) AS ts")
        units.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        sink = g.dedup_units_stream(stream, within="30 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out")
        run = sink.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        run.awaitTermination()
        seen.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(seen) <= 40 and seen[-1] <= 20  # 120 units in all
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("dsid").distinct().count() == 120


def test_marking_reads_the_buckets_of_its_units_alone(spark, rows, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"), buckets=8)
    units = [(ds, str(k)) for ds in ("a", "b", "") for k in range(40)]
    table.mark_run(rows(units, "ds string, id string"), at(0), "run")
    before = sorted(map(tuple, table.state().collect()))
    table.compact()
    assert sorted(map(tuple, table.state().collect())) == before and len(before) == 120
    one = rows([("a", "7")], "ds string, id string")
    plan = table.events(where=table._touched(one))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(src" in plan.replace("isnotnull(src", "(src") or "PartitionFilters: [" in plan and "src#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = table.events(where=table._touched(one)).inputFiles()
    got = table.events(where=table._touched(one)).collect()
    assert 0 < len(got) < 20 and ("a\x017" in {r["dsid"] for r in got}) and read
    # files of other buckets may be unreadable
    for path in (tmp_path / "ledger").rglob("src=b/bucket=*/*.parquet"):
        path.write_bytes(b"broken")
    table.mark_done(one, at(1), "done")
    table.mark_done(rows([("", "3")], "ds string, id string"), at(1), "done-2")
    table.mark_run(rows([("a", "7"), ("a", "new")], "ds string, id string"), at(2), "run-2")
    state = {r["dsid"]: r["status"] for r in table.state(ds="a").collect()}
    assert len(state) == 41 and state["a\x017"] == "done" and state["a\x01new"] == "run"
    assert {r["status"]: r["count"] for r in table.state(ds="").groupBy("status").count().collect()} == {"run": 39, "done": 1}


def test_a_compaction_of_nothing(spark, tmp_path):
    table = g.LedgerTable(spark, str(tmp_path / "ledger"))
    table.compact()
    assert table.state().count() == 0
