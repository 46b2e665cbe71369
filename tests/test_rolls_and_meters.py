import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import meters, rolls, trees

LINES = "key string, offset bigint, ts_ms bigint, line string"


def skewed(n=2000, seed=5):
    rng = random.Random(seed)
    ts, out = 0, []
    for i in range(n):
        ts += rng.choice([0, 1, 10, 400, 1000, 2500])
        out.append((rng.choice(["hot", "hot", "hot", "a", "b"]), i, ts, "é" * rng.randrange(0, 30)))
    return out


def test_an_empty_file_does_not_roll_and_a_full_one_does(rows):
    data = [("k", i, 0, str(i)) for i in range(1000)]
    rolled = rolls.size_rolls(rows(data, LINES), roll_bytes=10).collect()
    by_roll = {}
    for r in sorted(rolled, key=lambda r: r["offset"]):
        by_roll.setdefault(r["roll"], []).append(len(r["line"]) + 1)
    assert len(by_roll) > 100 and sum(map(len, by_roll.values())) == 1000
    assert rolls.size_rolls(rows(data[:1], LINES), roll_bytes=10).first()["roll"] == 0


@pytest.mark.parametrize("block_rows", [1, 100, 1 << 18])
def test_size_rolls_match_brute_force(rows, block_rows):
    data, written, want = skewed(), {}, {}
    for key, offset, _, line in data:
        want[offset] = written.get(key, 0) // 500
        written[key] = written.get(key, 0) + len(line.encode()) + 1
    got = rolls.size_rolls(rows(data, LINES), roll_bytes=500, block_rows=block_rows).collect()
    assert {r["offset"]: r["roll"] for r in got} == want


@pytest.mark.parametrize("idle", [1, 1000, 2500, 2501])
def test_idle_rolls_match_brute_force(rows, idle):
    files = {}
    for key, _, ts, line in skewed():
        mine = files.setdefault(key, [])
        if not mine or ts - mine[-1][1] >= idle:
            mine.append([ts, ts, 0, 0])
        mine[-1] = [mine[-1][0], ts, mine[-1][2] + 1, mine[-1][3] + len(line.encode()) + 1]
    got = rolls.idle_rolls(rows(skewed(), LINES), idle_ms=idle).collect()
    want = sorted((k, i, *f) for k, fs in files.items() for i, f in enumerate(fs))
    assert sorted((r["key"], r["roll"], r["first_ms"], r["last_ms"], r["n"], r["bytes"]) for r in got) == want


def test_idle_time_reached_closes_the_file(rows):
    at_once = rolls.idle_rolls(rows([("k", 0, 0, "hi"), ("k", 1, 999, "hi")], LINES), idle_ms=1000)
    assert at_once.count() == 1
    later = rolls.idle_rolls(rows([("k", 0, 0, "hi"), ("k", 1, 1000, "hi")], LINES), idle_ms=1000)
    assert later.count() == 2


def test_rates_and_total(rows):
    data = [("a", 0, 100, "xx"), ("a", 1, 900, "yyy"), ("b", 2, 950, "z"), ("b", 3, 1000, None), ("b", 4, 2500, "é")]
    df = rows(data, LINES).withColumnRenamed("key", "topic")
    got = meters.topic_throughput(df, window_ms=1000).collect()
    assert sorted((r["topic"], r["window_ms"], r["n"], r["bytes"], r["n_per_sec"], r["bytes_per_sec"]) for r in got) == [
        ("a", 0, 2, 5, 2.0, 5.0), ("b", 0, 1, 1, 1.0, 1.0), ("b", 2000, 1, 2, 1.0, 2.0),
        ("total", 0, 3, 6, 3.0, 6.0), ("total", 2000, 1, 2, 1.0, 2.0),
    ]
    assert {r["whole"] for r in got if r["topic"] == "total"} == {True}
    named = meters.topic_throughput(rows([("total", 0, 1, "x"), ("a", 1, 2, "y")], LINES).withColumnRenamed("key", "topic")).collect()
    assert sorted((r["topic"], r["whole"], r["n"]) for r in named) == [("a", False, 1), ("total", False, 1), ("total", True, 2)]


@pytest.mark.parametrize("slot_ms", [1, 3000, 1 << 40])
@pytest.mark.parametrize(("size", "idle"), [(200, 2500), (1, 1000), (10**9, 2500), (300, 10**9)])
def test_size_and_idle_rolls_match_brute_force(rows, slot_ms, size, idle):
    open_files, want = {}, {}
    for key, offset, ts, line in skewed(900):
        last, number, written = open_files.get(key, (ts, 0, 0))
        if ts - last >= idle:
            number, written = number + 1, 0
        want[offset] = (number, written // size)
        open_files[key] = (ts, number, written + len(line.encode()) + 1)
    got = rolls.size_and_idle_rolls(rows(skewed(900), LINES), roll_bytes=size, idle_ms=idle, seq=["offset"], slot_ms=slot_ms).collect()
    assert {r["offset"]: (r["idle_no"], r["roll"]) for r in got} == want


def test_size_and_idle_rolls_of_null_keys_and_no_lines(rows):
    data = [(None, 0, 0, "x"), (None, 1, 5000, "y"), (None, 2, 5001, None), ("k", 3, 0, "z")]
    got = rolls.size_and_idle_rolls(rows(data, LINES), roll_bytes=2, idle_ms=1000, seq=["offset"], slot_ms=10).collect()
    assert {r["offset"]: (r["idle_no"], r["roll"]) for r in got} == {0: (0, 0), 1: (1, 0), 2: (1, 1), 3: (0, 0)}
    assert rolls.size_and_idle_rolls(rows([], LINES), seq=["offset"]).count() == 0


def test_moving_rates_are_those_of_a_tick_by_tick_meter(rows):
    rng = random.Random(8)
    ticks = {k: sorted(rng.choice([rng.randrange(60), rng.randrange(40_000)]) for _ in range(150)) for k in ("a", None)}
    data = [(k, i, t * 5000 + rng.randrange(5000), "") for k, ts in ticks.items() for i, t in enumerate(ts)]
    got = {(r["key"], r["minute_ms"]): r for r in meters.moving_rates(rows(data, LINES), "key").collect()}
    seen = set()
    for key, ts in ticks.items():
        rates, counts = None, {t: ts.count(t) for t in ts}
        for t in range(min(ts), max(ts) // 12 * 12 + 12):
            now = counts.get(t, 0) / 5
            rates = [now] * 3 if rates is None else [r + (1 - math.exp(-5 / 60 / m)) * (now - r) for r, m in zip(rates, meters.MINUTES)]
            minute = t // 12
            if t % 12 == 11 and any(x // 12 == minute for x in ts):
                row = got[key, minute * 60_000]
                seen.add((key, minute * 60_000))
                for m, want in zip(meters.MINUTES, rates):
                    assert row[f"rate_{m}"] == pytest.approx(want, rel=1e-9, abs=1e-15)
    assert seen == set(got)
    assert meters.moving_rates(rows([], LINES), "key").count() == 0


def test_sketches_of_doubles_and_odd_values(rows):
    rng = random.Random(4)
    data = [("n", k * 10, rng.random()) for k in range(20_000)] + [("one", 0, 2.5), ("none", 0, None), (None, 0, -1.0)]
    sketches = meters.value_sketches(rows(data, "name string, ts_ms bigint, value double"))
    assert sketches.count() == 4 + 2
    got = {(r["name"], r["q"]): r for r in meters.sketched_quantiles(sketches, ["name"]).collect()}
    values = sorted(v for name, _, v in data if name == "n")
    for q in meters.QUANTILES:
        assert abs(sum(v <= got["n", q]["value"] for v in values) / len(values) - q) < 0.02
        assert got["one", q]["value"] == 2.5 and got[None, q]["value"] == -1.0
    assert got["n", 0.5]["n"] == 20_000 and got["n", 0.5]["max"] == values[-1]


def test_counters(rows):
    df = rows([("a", 3), ("a", -1), ("b", 1)], "name string, delta bigint")
    assert {r["name"]: r["value"] for r in meters.counter_totals(df).collect()} == {"a": 2, "b": 1}


def test_offset_ranges(rows):
    df = rows([("t", 0, o) for o in (3, 1, 2, 7)], "topic string, partition int, offset bigint")
    got = meters.offset_ranges(df, F.floor(F.col("offset") / 5)).collect()
    assert sorted((r["batch"], r["min_offset"], r["max_offset"], r["n"]) for r in got) == [(0, 1, 3, 3), (1, 7, 7, 1)]


@pytest.mark.parametrize("block", [1, 100, 1 << 16])
def test_distribution_is_exact(rows, block):
    rng = random.Random(2)
    data = [("hot", rng.randrange(-5000, 5000)) for _ in range(3000)] + [("few", 7), ("few", 9), ("few", 9), ("one", -3)]
    got = {r["name"]: r for r in meters.value_distribution(rows(data, "name string, value bigint"), block=block).collect()}
    for name in ("hot", "few", "one"):
        values = sorted(v for n, v in data if n == name)
        r = got[name]
        assert (r["n"], r["min"], r["max"]) == (len(values), values[0], values[-1])
        assert r["mean"] == pytest.approx(statistics.mean(values))
        for q, column in ((0.5, "p50"), (0.95, "p95"), (0.999, "p99_9")):
            assert r[column] == values[max(math.ceil(round(q * len(values), 6)), 1) - 1]
        if len(values) > 1:
            assert r["stddev"] == pytest.approx(statistics.stdev(values))


def test_spread_of_large_close_values(rows):
    values = [1_700_000_000_000_000 + d for d in (0, 1, 2, 70_000, 70_001)]
    got = meters.value_distribution(rows([("n", v) for v in values], "name string, value bigint")).first()
    assert got["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-9)
    assert got["mean"] == pytest.approx(statistics.mean(values), abs=0.5)


PATHS = [("/a/b/1", "x"), ("a//b/2/", "y"), ("/a/c", "z"), ("/ab/c", "no"), ("/a/b/2/deep/er", "w"), ("/a", "root")]


def test_children_are_sorted_names(rows):
    df = rows(PATHS, "path string, value string")
    assert [r["child"] for r in trees.list_children(df, "/a/b").collect()] == ["1", "2"]
    assert [r["child"] for r in trees.list_children(df, "/a/").collect()] == ["b", "c"]
    assert [r["child"] for r in trees.list_children(df, "/").collect()] == ["a", "ab"]
    assert trees.list_children(df, "/none").count() == 0


def test_tree_shows_values_at_leaves_and_at_the_last_level(rows):
    got = trees.path_tree(rows(PATHS, "path string, value string"), "/a", 2).collect()
    assert {r["path"]: (r["level"], r["has_children"], r["value"]) for r in got} == {
        "/a/b": (1, True, None),
        "/a/c": (1, False, "z"),
        "/a/b/1": (2, False, "x"),
        "/a/b/2": (2, True, "y"),
    }
