"""Which sink has committed which batch, so that a restarted batch does no target twice.

``fan_out`` runs a failed batch again for all its sinks. With a ledger a sink that has committed the batch is skipped. A sink
that failed, or was lost after its write and before its entry, gets the batch again under the same name and replaces what it
wrote: files by batch folder, table rows by key, relational rows by a batch column, key-value pairs by key.

The ledger is a Parquet table (sink, batch, rows, committed_at) with a folder per query, sink and batch; an entry is one small write
that is complete or absent. Looking one up lists no folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerwell.sinks.external import HOT_REVENUE, METRICS_SUFFIX, SAMPLE_SHARE, flatten_window, hot_users, sample_rows
from layerwell.streaming.layers import GOLD_MATCH, MINUTE_TRIGGER, flat_metrics, gold_table_sink
from layerwell.streaming.writers import Sink, Trigger, append_evolving, fan_out, path_exists

ENTRY = "sink string, batch string, rows long, committed_at timestamp"


class BatchLedger:
    """Committed batches of any number of queries and sinks, below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entry(self, sink: str, batch: str) -> str:
        query, _, number = batch.rpartition("/")
        return f"{self.path}/query={query or 'none'}/target={sink}/number={number}"

    def committed(self, sink: str, batch: str) -> bool:
        return path_exists(self.spark, f"{self._entry(sink, batch)}/_SUCCESS")

    def commit(self, sink: str, batch: str, rows: int) -> None:
        entry = self.spark.createDataFrame([(sink, batch, rows)], "sink string, batch string, rows long")
        entry.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(self._entry(sink, batch))

    def entries(self) -> DataFrame:
        """All commits: sink, batch, rows, committed_at."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(f"{ENTRY}, query string, target string, number string").parquet(self.path).select(
            "sink", "batch", "rows", "committed_at"
        )

    def once(self, name: str, sink: Sink) -> Sink:
        """The sink, run for batches it has not committed yet; rows are counted as they are written."""

        def put(batch: DataFrame, batch_name: str) -> None:
            if self.committed(name, batch_name):
                return
            seen = Observation()
            sink(batch.observe(seen, F.count(F.lit(1)).alias("rows")), batch_name)
            self.commit(name, batch_name, seen.get["rows"])

        return put


Writer = Callable[[DataFrame, str], None]


def files(path: str) -> Writer:
    """Writer of one folder per batch; a repeated batch replaces its folder."""
    return lambda rows, batch: append_evolving(rows, path, batch)


def metrics_sink(table: str, writer: Writer) -> Sink:
    """Flat metrics for a relational table; only tables named ``*metrics`` are written."""

    def put(batch: DataFrame, name: str) -> None:
        rows = flatten_window(batch)
        # Another table gets nothing, but the batch is still read, so that its rows are counted.
        writer(rows if table.endswith(METRICS_SUFFIX) else rows.where("false"), name)

    return put


def sample_sink(writer: Writer, fraction: float = SAMPLE_SHARE) -> Sink:
    """A sample of the windows by key, for an index; a window is always in or always out."""
    return lambda batch, name: writer(sample_rows(flat_metrics(batch), list(GOLD_MATCH), fraction), name)


def hot_users_sink(writer: Writer, threshold: float = HOT_REVENUE) -> Sink:
    """Users of windows with much revenue and their largest one, as pairs for a key-value store."""

    def put(batch: DataFrame, name: str) -> None:
        writer(hot_users(batch, threshold).groupBy("user_id").agg(F.max("total_revenue").alias("total_revenue")), name)

    return put


def gold_targets(table: str, metrics: Writer, index: Writer, pairs: Writer, threshold: float = HOT_REVENUE) -> dict[str, Sink]:
    """The four targets of the gold layer by name."""
    return {
        "table": gold_table_sink(table),
        "metrics": metrics_sink("user_metrics", metrics),
        "index": sample_sink(index),
        "hot_users": hot_users_sink(pairs, threshold),
    }


def write_targets(
    metrics: DataFrame, targets: Mapping[str, Sink], ledger: BatchLedger, checkpoint: str, trigger: Trigger = MINUTE_TRIGGER
) -> StreamingQuery:
    """Send changed windows to every target, each batch once per target."""
    return fan_out(metrics, [ledger.once(name, sink) for name, sink in targets.items()], checkpoint, trigger, "update")
