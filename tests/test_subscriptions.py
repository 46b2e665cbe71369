"""Topics that come and go: each reads its own messages once, whatever happened to its query."""

import collections
import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources.topics import read_topic_files
from millrace.streaming.jobs import triggered
from millrace.streaming.subscriptions import Subscriptions

RECORDS = "topic string, n bigint"


class Feed:
    def __init__(self, spark, folder, every, attempts=2):
        self.spark, self.folder, self.every, self.n, self.wanted = spark, folder, every, 0, []
        self.broken, self.starts = set(), collections.Counter()
        self.subscriptions = Subscriptions(spark, self.load, self.start, f"{folder}/state", attempts)
        self.send()

    def load(self, spark):
        return spark.createDataFrame([(t,) for t in self.wanted], "topic string")

    def start(self, topic, checkpoint):
        self.starts[topic] += 1
        feed = self

        def write(batch, number):
            if topic in feed.broken:
                raise ValueError("broken")
            batch.write.mode("overwrite").parquet(f"{feed.folder}/out/of={feed.starts[topic]}/batch={number}-{topic.encode().hex()}")

        stream = read_topic_files(self.spark, f"{self.folder}/in", RECORDS, [topic])
        return triggered(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), self.every).start()

    def send(self, *topics):
        rows = [(t, self.n + i) for i, t in enumerate(topics)]
        self.n += len(rows)
        self.spark.createDataFrame(rows, RECORDS).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def got(self):
        try:
            found = self.spark.read.schema(RECORDS).option("recursiveFileLookup", True).parquet(f"{self.folder}/out")
        except Exception:
            return {}
        return {r["topic"]: sorted(r["n"]) for r in found.groupBy("topic").agg(F.collect_list("n").alias("n")).collect()}

    def step(self, *wanted):
        self.wanted = list(wanted)
        out = self.subscriptions.refresh()
        self.subscriptions.await_all()
        return out


def until(test, seconds=60):
    end = time.monotonic() + seconds
    while not test():
        assert time.monotonic() < end
        time.sleep(0.2)


def test_a_topic_that_comes_back_goes_on_where_it_was(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), every=None)
    feed.send("a", "b", "a")
    assert feed.step("a", None, "a") == (["a"], [])
    feed.send("a", "b")
    feed.step("b", "c/d")  # a is gone, a topic without messages is there
    assert feed.got() == {"a": [0, 2], "b": [1, 4]}
    feed.send("a", "c/d", "b")
    feed.step("a")
    assert feed.got() == {"a": [0, 2, 3, 5], "b": [1, 4]}
    feed.step("c/d", "b", "a")
    assert feed.got() == {"a": [0, 2, 3, 5], "b": [1, 4, 7], "c/d": [6]}
    assert feed.step() == ([], [])


def test_running_queries_are_started_and_stopped_as_the_list_changes(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), every="200 milliseconds")
    feed.wanted = ["a", "b"]
    assert feed.subscriptions.refresh() == (["a", "b"], [])
    feed.send("a", "b")
    until(lambda: feed.got() == {"a": [0], "b": [1]})
    assert feed.subscriptions.refresh() == ([], [])  # nothing has changed, nothing is started anew
    feed.wanted = ["b", "c"]
    assert feed.subscriptions.refresh() == (["c"], ["a"])
    assert feed.subscriptions.active() == ["b", "c"]
    feed.send("a", "b", "c")
    until(lambda: feed.got() == {"a": [0], "b": [1, 3], "c": [4]})
    feed.wanted = ["a"]
    assert feed.subscriptions.refresh() == (["a"], ["b", "c"])
    until(lambda: feed.got()["a"] == [0, 2])
    feed.wanted = []
    assert feed.subscriptions.refresh() == ([], ["a"]) and feed.subscriptions.active() == []
    assert feed.starts == {"a": 2, "b": 1, "c": 1}


def test_a_failed_query_is_started_again_and_the_others_go_on(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), every="200 milliseconds")
    feed.wanted, feed.broken = ["a", "b"], {"a"}
    stop = threading.Event()
    runner = threading.Thread(target=feed.subscriptions.run, args=(stop, 60))
    runner.start()
    feed.send("a", "b")
    try:
        until(lambda: feed.starts["a"] >= 2)  # woken by the end of the query, long before the interval is over
        feed.broken = set()
        until(lambda: feed.got() == {"a": [0], "b": [1]})
        assert feed.starts["b"] == 1
    finally:
        stop.set()
        runner.join(60)
    assert not runner.is_alive() and feed.subscriptions.queries == {}


def test_the_error_is_raised_after_the_last_attempt(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), every=None)
    feed.wanted, feed.broken = ["a", "b"], {"a"}
    feed.send("a", "b")

    def settle():
        until(lambda: not any(q.isActive for q in feed.subscriptions.queries.values()))

    for _ in range(3):
        feed.subscriptions.refresh()
        settle()
    with pytest.raises(Exception, match="broken"):
        feed.subscriptions.refresh()
    settle()
    assert feed.starts["a"] == 3 and feed.got() == {"b": [1]}
    feed.wanted = ["b"]
    feed.subscriptions.refresh()  # the topic is gone, and its error with it
    settle()
    feed.broken, feed.wanted = set(), ["a"]
    feed.subscriptions.refresh()
    settle()
    assert feed.got() == {"a": [0], "b": [1]}
