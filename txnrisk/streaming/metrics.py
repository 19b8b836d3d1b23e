"""Counters, rates and times of every micro-batch, kept in the metrics table."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from txnrisk.sinks.append import append_batch
from txnrisk.sources.tables import batch_number

SCHEMA = "layer string, micro_batch bigint, name string, value double, ts timestamp"


def measures(progress) -> dict[str, float]:
    """What a query's progress says about a micro-batch; late and repeated rows are those its state dropped."""
    state = progress.stateOperators
    return {
        "n_input": progress.numInputRows,
        "input_rows_per_second": progress.inputRowsPerSecond,
        "processed_rows_per_second": progress.processedRowsPerSecond,
        "n_late": sum(x.numRowsDroppedByWatermark for x in state),
        "n_repeated": sum(x.customMetrics.get("numDroppedDuplicateRows", 0) for x in state),
        "n_state_rows": sum(x.numRowsTotal for x in state),
        **{f"{name}_ms": ms for name, ms in progress.durationMs.items()},
    }


class BatchMetrics(StreamingQueryListener):
    """Joins the layers' own counters with the progress of their queries and writes a row per value.

    Counters come from the batch functions (``report``), progress from Spark, after the batch is committed. A
    micro-batch owns a partition of the table, so one that is repeated replaces its values. Listener calls
    only note what came; :meth:`write` stores it, and runs every ``interval`` seconds between :meth:`start` and
    :meth:`stop`.
    """

    def __init__(self, spark: SparkSession, path: str, interval: float = 10.0):
        self.spark, self.path, self.interval = spark, path, interval
        self._lock = threading.Lock()
        self._layers: dict[str, tuple[str, int]] = {}
        self._counters: dict[tuple[str, int], dict] = {}
        self._progress: list = []
        self._ended: set[str] = set()
        self._stopped = threading.Event()
        self._writer: threading.Thread | None = None

    def report(self, layer: str, micro_batch: int, counters: dict) -> None:
        with self._lock:
            self._counters[layer, micro_batch] = dict(counters)

    def watch(self, query: StreamingQuery, layer: str, generation: int = 0) -> None:
        """Tell which layer a query feeds, and the generation of its checkpoint, which sets its numbers apart."""
        with self._lock:
            self._layers[str(query.runId)] = layer, generation

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._progress.append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def write(self) -> None:
        """Store what has come of the watched queries; that of others is left for later."""
        with self._lock:
            known = [p for p in self._progress if str(p.runId) in self._layers]
            self._progress = [p for p in self._progress if str(p.runId) not in self._layers]
            now, rows = datetime.now(timezone.utc), []
            for p in known:
                layer, generation = self._layers[str(p.runId)]
                number = batch_number(generation, p.batchId)
                values = measures(p) | self._counters.pop((layer, number), {})
                rows += [(layer, number, k, None if v is None else float(v), now) for k, v in values.items()]
        if rows:
            append_batch(self.spark.createDataFrame(rows, SCHEMA).coalesce(1), self.path, "layer", "micro_batch")

    def start(self) -> BatchMetrics:
        def run() -> None:
            while not self._stopped.wait(self.interval):
                self.write()

        self.spark.streams.addListener(self)
        self._writer = threading.Thread(target=run, daemon=True)
        self._writer.start()
        return self

    def stop(self, patience: float = 30.0) -> None:
        """Wait until the ended queries' events are here, as these come a little later, then store the rest."""
        until = time.monotonic() + patience
        active = {str(q.runId) for q in self.spark.streams.active}
        while set(self._layers) - active - self._ended and time.monotonic() < until:
            time.sleep(0.05)
        self._stopped.set()
        if self._writer is not None:
            self._writer.join()
        self.spark.streams.removeListener(self)
        self.write()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
