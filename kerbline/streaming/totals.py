"""Totals of streaming queries over all of their batches.

A query's own progress keeps its last 100 batches only. The listener here adds every batch up as it is reported: rows read,
rows that a watermark dropped, and what the stream observes about itself (``observe`` in ``jobs.with_dead_letters``).
"""

import threading
from collections import Counter, defaultdict
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

BATCHES, INPUT, DROPPED = "batches", "input", "dropped_by_watermark"
SCHEMA = "query_id string, run_id string, metric string, n long"


class Totals(StreamingQueryListener):
    """Sums of the metrics of each run of each query."""

    def __init__(self):
        self._changed = threading.Condition()
        self._runs = defaultdict(Counter)
        self._ended = set()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        found = Counter(
            {
                BATCHES: 1,
                INPUT: progress.numInputRows,
                DROPPED: sum(o.numRowsDroppedByWatermark for o in progress.stateOperators),
            }
        )
        for row in progress.observedMetrics.values():
            found.update({name: n for name, n in row.asDict().items() if n is not None})
        with self._changed:
            self._runs[str(progress.id), str(progress.runId)].update(found)

    def onQueryTerminated(self, event):
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def of(self, query, timeout=60):
        """The sums of one run. A run that has ended is waited for: reports reach listeners a little later."""
        with self._changed:
            if not query.isActive and not self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"no end of query {query.id} after {timeout} s")
            return dict(self._runs[str(query.id), str(query.runId)])

    def frame(self, spark):
        """A row for each run and metric."""
        with self._changed:
            rows = [(*run, name, int(n)) for run, sums in self._runs.items() for name, n in sums.items()]
        return spark.createDataFrame(rows, SCHEMA)

    def keep(self, spark, path):
        """Append the sums to a table, so that ``kept`` adds up all runs of a query, whatever session they ran in."""
        self.frame(spark).write.mode("append").parquet(path)


def kept(spark, path):
    """query_id, metric, n over all runs that were kept; a run that was kept again later counts once, with its last sums."""
    runs = spark.read.parquet(path).groupBy("query_id", "run_id", "metric").agg(F.max("n").alias("n"))
    return runs.groupBy("query_id", "metric").agg(F.sum("n").alias("n"))


@contextmanager
def listening(spark):
    """Totals of all queries that run meanwhile."""
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        yield totals
    finally:
        spark.streams.removeListener(totals)
