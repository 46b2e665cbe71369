import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import blocks, joins, messages as m, processing, routing
from millrace.functions.payload import definition_list

SCHEMA = "topic string, partition int, offset bigint, value string"


def skewed(n=3000, seed=1):
    """A topic with more than a third of the rows, one with few, and rows without topic."""
    rng = random.Random(seed)
    topics = ["hot"] * 6 + ["a", "b", None]
    return [(rng.choice(topics), i % 3, i, f"v{i}") for i in range(n)]


def test_message_fields_round_trip(rows):
    df = rows([("hi", "ds", "ids", "hi", True, 0, 1)], "value string, ds string, ids string, topic string, accept boolean, ts bigint, priority int")
    got = m.make_message(df).first()
    assert ([bytes(b) for b in got["payloads"]], got["ids"]) == ([b"hi"], ["ids"])
    assert (got["ds"], got["topic"], got["accept"], got["ts"], got["priority"]) == ("ds", "hi", True, 0, 1)


def test_lists_stay_lists_and_payload_can_change(rows):
    df = rows([(["a", "b"], "ds", ["1", "2"], "t", True, 0, 1)], "value array<string>, ds string, ids array<string>, topic string, accept boolean, ts bigint, priority int")
    made = m.make_message(df)
    assert [r["id"] for r in m.explode_ids(made).orderBy("id").collect()] == ["1", "2"]
    changed = m.change_payload(made, F.array(F.lit("z").cast("binary"))).first()
    assert [bytes(b) for b in changed["payloads"]] == [b"z"] and changed["ids"] == ["1", "2"]


def test_explode_flattens_nested_lists(rows):
    df = rows([("t", [["a"], ["b", "c"]])], "topic string, payloads array<array<string>>")
    assert [(r["pos"], r["value"]) for r in m.explode_payloads(df).orderBy("pos").collect()] == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("block_rows", [1, 64, 10_000])
def test_batches_match_brute_force_for_any_block_size(rows, block_rows):
    data = skewed()
    got = m.batch_messages(rows(data, SCHEMA), 7, block_rows=block_rows).collect()
    seen, want = {}, {}
    for topic, _, offset, _ in sorted(data, key=lambda r: r[1:3]):
        want[offset] = seen.get(topic, 0) // 7
        seen[topic] = seen.get(topic, 0) + 1
    assert {r["offset"]: r["batch"] for r in got} == want and len(got) == len(data)


def test_no_block_passes_its_bound_whatever_the_partitions(rows):
    data = [("t", p, o, f"{o}-{p}") for p in range(100) for o in range(12)]
    frame = rows(data, SCHEMA)
    got = m.batch_messages(frame, 5, block_rows=4).collect()
    want = {(o, p): i // 5 for i, (p, o) in enumerate((p, o) for p in range(100) for o in range(12))}
    assert {(r["offset"], r["partition"]): r["batch"] for r in got} == want
    sizes = frame.groupBy("topic", blocks.seq_block("offset", 4, ["partition"]).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] == 4
    groups = m.group_by_key(frame, ["topic"], value="value", group_rows=10).collect()
    assert max(r["n"] for r in groups) <= 10 and sum(r["n"] for r in groups) == 1200


def test_batches_end_at_the_first_null(rows):
    data = [("t", 0, i, None if i in (5, 8) else str(i)) for i in range(12)] + [("u", 0, i, str(i)) for i in range(4)]
    got = m.batch_messages(rows(data, SCHEMA), 3, stop_at_null="value", block_rows=2).collect()
    assert sorted((r["topic"], r["offset"], r["batch"]) for r in got) == [("t", i, i // 3) for i in range(5)] + [("u", i, i // 3) for i in range(4)]


def test_pack_and_group_keep_every_line(rows):
    data = [r for r in skewed() if r[0]]
    df = rows(data, SCHEMA).withColumn("id", F.col("offset").cast("string"))
    packed = m.pack_messages(m.batch_messages(df, 50)).collect()
    assert sorted(v for r in packed for v in r["payloads"]) == sorted(r[3] for r in data)
    assert max(len(r["ids"]) for r in packed) == 50
    groups = m.group_by_key(df, ["topic"], value="value", group_rows=100).collect()
    assert max(r["n"] for r in groups) <= 100 and sum(r["n"] for r in groups) == len(data)
    hot = [v for r in sorted((g for g in groups if g["topic"] == "hot"), key=lambda g: (g["partition"], g["part"])) for v in r["lines"]]
    assert hot == [r[3] for r in sorted(data, key=lambda r: r[1:3]) if r[0] == "hot"]


def test_priority_order(rows):
    df = rows([(2, 5, "a", 0, 1), (1, 9, "b", 0, 2), (1, 3, "c", 0, 3)], "priority int, ts int, topic string, partition int, offset int")
    assert [r["topic"] for r in m.priority_order(df).collect()] == ["c", "b", "a"]


def test_numbers_follow_the_order(spark, rows):
    data = [(random.Random(i).randrange(50), i) for i in range(2000)]
    got = blocks.number_rows(rows(data, "a int, b int"), ["a", "b"]).collect()
    assert {(r["a"], r["b"]): r["rownum"] for r in got} == {k: i for i, k in enumerate(sorted(data), 1)}


def routed_sets(df, routes):
    sent = routing.route(df, routes)
    lost = routing.unroutable(df, routes)
    return sorted(r["offset"] for r in sent.collect()), sorted(r["offset"] for r in lost.collect()), sent


def test_routing_splits_all_messages(rows):
    data = skewed()
    routes = rows([("hot", "p"), ("a", "q")], "topic string, processor string")
    sent, lost, _ = routed_sets(rows(data, SCHEMA), routes)
    assert sent == [r[2] for r in data if r[0] in ("hot", "a")]
    assert lost == [r[2] for r in data if r[0] not in ("hot", "a")]


def test_large_routes_are_salted_not_broadcast(rows, no_broadcast):
    data = skewed()
    routes = rows([("hot", "p"), ("a", "q")], "topic string, processor string")
    assert not joins.fits_broadcast(routes)
    sent, lost, df = routed_sets(rows(data, SCHEMA), routes)
    assert len(sent) + len(lost) == len(data) and len(set(sent)) == len(sent)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "Broadcast" not in plan


def test_a_derived_table_is_measured_not_guessed(spark, rows):
    """A few topics of a stream that is itself too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        df = spark.range(20_000).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("topic"),
            F.lit(0).alias("partition"), F.col("id").alias("offset"),
        )
        few = df.select("topic").distinct().withColumn("processor", F.lit("p"))
        assert not joins.fits_broadcast(few) and joins.fits_broadcast(joins.settled(few))
        sent = routing.route(df, few)
        assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString() and sent.count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_message_without_processor_stops_the_job(rows):
    routes = rows([("a", "q")], "topic string, processor string")
    with pytest.raises(Exception, match="no processor for topic hot"):
        routing.route_or_fail(rows([("hot", 0, 1, "x")], SCHEMA), routes).collect()
    assert routing.route_or_fail(rows([("a", 0, 1, "x")], SCHEMA), routes).first()["processor"] == "q"


def test_dispatch_hands_out_every_message(rows):
    seen = {}
    routes = rows([("hot", "p"), ("a", "q")], "topic string, processor string")
    routed = routing.route(rows(skewed(), SCHEMA), routes)
    routing.dispatch(routed, {n: lambda d, n=n: seen.update({n: d.count()}) for n in ("p", "q")})
    assert sum(seen.values()) == routed.count() and set(seen) == {"p", "q"}


def test_no_row_is_both_good_and_dead(rows):
    data = [("t", 0, 0, '{"a":1}'), ("t", 0, 1, '{"a"'), ("t", 0, 2, None), ("u", 0, 3, "plain")]
    settings = rows([("t", "json-csv", "json", "now")], "topic string, encoder string, decoder string, time_parser string")
    defs = definition_list('[["a","0"]]')
    resolved = settings.withColumn(
        "definitions",
        F.array(*[F.struct(F.array(*[F.lit(s) for s in path]).alias("path"), F.lit(d).alias("default")) for path, d in defs]),
    )
    df = rows(data, SCHEMA)
    decoded = processing.decode_messages(processing.with_settings(df, resolved))
    good = {r["offset"] for r in processing.drop_null_payload(decoded).collect()}
    dead = {r["offset"] for r in processing.dead_letter(decoded).collect()}
    assert (good, dead) == ({0, 3}, {1})
    lines = processing.process_messages(df, resolved, F.lit(0).cast("bigint")).collect()
    assert {(r["offset"], r["line"], r["key"]) for r in lines} == {(0, "1", "t_1970010100"), (3, "plain", "u_1970010100")}
