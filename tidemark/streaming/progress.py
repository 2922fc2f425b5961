"""What the batches of running streams did, as a table.

Spark reports each micro-batch to a listener when it is done: rows read, rows a stateful step
dropped as late, rows its state holds, and the counts observed in the stream. The listener
writes a small JSON file per batch; reading the folder gives the table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources import paths

PROGRESS = (
    "query string, run string, batch bigint, input_rows bigint, late_rows bigint, "
    "state_rows bigint, observed map<string, map<string, bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of a session's streams, or of those of some ids, to a folder.

    A batch is named by its stream and number: one that is reported again is written once. Batches
    without input count too, as they can drop state.
    """

    def __init__(self, spark: SparkSession, path: str, queries: set[str] | None = None):
        self.spark = spark
        self.path = path
        self.queries = queries

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if self.queries is not None and str(progress.id) not in self.queries:
            return
        steps = progress.stateOperators
        row = {
            "query": str(progress.id),
            "run": str(progress.runId),
            "batch": progress.batchId,
            "input_rows": progress.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in steps),
            "state_rows": sum(s.numRowsTotal for s in steps),
            "observed": {
                name: {key: int(n or 0) for key, n in values.asDict().items()}
                for name, values in progress.observedMetrics.items()
            },
        }
        name = f"{self.path}/{row['query']}-{row['batch']:012d}-{row['run']}.json"
        paths.write_new(self.spark, name, json.dumps(row))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The batches written so far, each once.

    A batch can be reported again after a restart. Where the sink has it already it is not
    computed again, and reports nothing: the report with the most rows counts.
    """
    rows = spark.read.schema(PROGRESS).json(path)
    fullest = F.max_by(F.struct(*rows.columns), F.struct("input_rows", "late_rows", "run"))
    return rows.groupBy("query", "batch").agg(fullest.alias("b")).select("b.*")


def observe_outcomes(parsed: DataFrame, name: str = "outcomes") -> DataFrame:
    """The parsed stream with its outcomes counted on the way, without a job of its own."""
    rejected = F.size("errors") > 0
    return parsed.observe(
        name, F.count_if(~rejected).alias("accepted"), F.count_if(rejected).alias("rejected")
    )


def outcome_counts(progress: DataFrame, name: str = "outcomes") -> DataFrame:
    """(outcome, records) of all batches of a table of progress."""
    return (
        progress.select(F.explode(F.col("observed")[name]).alias("outcome", "records"))
        .groupBy("outcome")
        .agg(F.sum("records").alias("records"))
    )
