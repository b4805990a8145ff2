"""What streams report while they run."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "run long, batch long, input_rows long, name string, value long"


class Progress(StreamingQueryListener):
    """Rows read and observed counts of each batch, by run of a stream; a batch that reports twice counts once."""

    def __init__(self):
        self.batches: dict[tuple[int, int], tuple[int, dict[str, int]]] = {}
        self.runs: dict[str, int] = {}
        self.ended = threading.Condition()
        self.over: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.runs.setdefault(str(event.runId), len(self.runs))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        counts = {name: int(row[name]) for name, row in told.observedMetrics.items() if row[name] is not None}
        self.batches[self.runs.setdefault(str(told.runId), len(self.runs)), told.batchId] = told.numInputRows, counts

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.ended:
            self.over.add(str(event.runId))
            self.ended.notify_all()

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until the run has reported its end, and with it all its batches."""
        with self.ended:
            if not self.ended.wait_for(lambda: run_id in self.over, seconds):
                raise TimeoutError("the stream's end wasn't reported")

    def rows(self, spark: SparkSession) -> DataFrame:
        """run, batch, input_rows and each observed count of the batches with input."""
        told = [(run, batch, n, name, value) for (run, batch), (n, counts) in self.batches.items() if n for name, value in counts.items()]
        return spark.createDataFrame(told, PROGRESS)

    def text(self) -> str:
        return json.dumps([{"run": r, "batch": b, "rows": n, **c} for (r, b), (n, c) in sorted(self.batches.items())])


def observed(stream: DataFrame, **counts: Column) -> DataFrame:
    """The stream as it was; each batch reports how many of its rows meet each condition, on the way."""
    for name, condition in counts.items():
        stream = stream.observe(name, F.count_if(condition).alias(name))
    return stream


def counted(counts: DataFrame, path: str) -> tuple[DataFrame, str]:
    """Runs a stream of running counts over what is there now, from its checkpoint under `path` on; all counts, and the id of the run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/counts")

    query = counts.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return counts.sparkSession.read.schema(counts.schema).parquet(f"{path}/counts"), str(query.runId)
