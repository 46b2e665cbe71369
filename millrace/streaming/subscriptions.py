"""Topics that come and go while their streams run.

Every wanted topic has a streaming query and a checkpoint of its own. A topic that is no longer wanted is
stopped after its micro-batch, one that is wanted again goes on where it was: what arrived meanwhile is read then, once.
A query that fails is started again on its checkpoint and leaves the other topics alone.
"""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.operators.settings import topics_to_add, topics_to_remove

EVERY_S = 10.0
ATTEMPTS = 5


class Changes(StreamingQueryListener):
    """Wakes the subscriptions when one of their queries ends. Callbacks only set a flag, so they hold up no query."""

    def __init__(self, wake: threading.Event) -> None:
        self.wake, self.ids = wake, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.ids:
            self.wake.set()


class Subscriptions:
    """The queries of a changing list of topics.

    ``load(session)`` gives the wanted topics now, as a table with a column ``topic`` (NULLs and repeated topics
    do not count). ``start(topic, checkpoint)`` starts the query of one topic. Its checkpoint is
    ``<checkpoints>/topic=<topic>``. The list of topics is a table of settings: it is collected.

    A query that fails is started again, ``attempts`` times in a row at most; then :meth:`refresh` raises its error,
    and the other queries go on. A query that makes progress has its attempts back. A query that comes to its end
    by itself (all that was there) is started again by the next refresh if its topic is wanted.
    """

    def __init__(
        self, spark: SparkSession, load: Callable[[SparkSession], DataFrame],
        start: Callable[[str, str], StreamingQuery], checkpoints: str, attempts: int = ATTEMPTS,
    ) -> None:
        self.spark, self.load, self.start = spark, load, start
        self.checkpoints, self.attempts = checkpoints.rstrip("/"), attempts
        self.queries: dict[str, StreamingQuery] = {}
        self.failures: Counter[str] = Counter()
        self.wake = threading.Event()
        self.listener = Changes(self.wake)

    def checkpoint(self, topic: str) -> str:
        return f"{self.checkpoints}/topic={quote(topic, safe='')}"

    def active(self) -> list[str]:
        return sorted(t for t, q in self.queries.items() if q.isActive)

    def refresh(self) -> tuple[list[str], list[str]]:
        """Stop what is no longer wanted, start what is; both lists of topics, first the started."""
        errors = self._reap()
        kind = "topic string"
        wanted = self.load(self.spark).select("topic").where("topic is not null")
        running = self.spark.createDataFrame([(t,) for t in self.queries], kind)
        gone = sorted(r["topic"] for r in topics_to_remove(wanted, running).collect())
        new = sorted(r["topic"] for r in topics_to_add(wanted, running).collect())
        for topic in gone:
            self._stop(topic)
        kept, self.failures = self.failures, Counter()
        for topic in set(new) | set(self.queries):
            self.failures[topic] = kept[topic]  # a topic that went and comes back begins anew
        started = []
        for topic in new:
            if topic in errors and self.failures[topic] > self.attempts:
                continue
            self.queries[topic] = query = self.start(topic, self.checkpoint(topic))
            self.listener.ids.add(str(query.runId))
            started.append(topic)
        for topic, error in errors.items():
            if topic in new and topic not in started:
                raise error
        return started, gone

    def _reap(self) -> dict[str, Exception]:
        """Forget queries that ended, count those that failed, and give their errors."""
        errors: dict[str, Exception] = {}
        for topic, query in list(self.queries.items()):
            if query.isActive:
                if self.failures[topic] and query.lastProgress:
                    self.failures[topic] = 0
                continue
            if error := query.exception():
                made_progress = bool(query.lastProgress)
                self.failures[topic] = 1 if made_progress else self.failures[topic] + 1
                errors[topic] = error
            self._forget(topic)
        return errors

    def _stop(self, topic: str) -> None:
        if topic in self.queries:
            query = self.queries[topic]
            while query.isActive and query.status["isTriggerActive"]:
                time.sleep(0.05)  # a micro-batch that is under way comes to its end
            query.stop()
            self._forget(topic)

    def _forget(self, topic: str) -> None:
        self.listener.ids.discard(str(self.queries.pop(topic).runId))

    def await_all(self) -> None:
        """Wait until all queries have come to their end, as those do that read what is there."""
        for query in list(self.queries.values()):
            query.awaitTermination()

    def run(self, stop: threading.Event, every_s: float = EVERY_S) -> None:
        """Refresh at an interval, and at once where a query ends, until ``stop`` is set or a
        query has failed too often; then stop all queries."""
        self.spark.streams.addListener(self.listener)
        try:
            while not stop.is_set():
                self.wake.clear()
                self.refresh()
                until = time.monotonic() + every_s
                while not stop.is_set() and time.monotonic() < until and not self.wake.wait(min(0.2, every_s)):
                    pass
        finally:
            self.spark.streams.removeListener(self.listener)
            for topic in list(self.queries):
                self._stop(topic)
