"""Counts that are taken while rows pass on their way to a table, without a scan of their own."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger("corpusloom")

#: Rows of ids and titles that are sent to all tasks, so that the texts which they are joined with stay where they are.
FEW = 50_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if it has at most FEW ``rows``; else Spark chooses how to join it."""
    return F.broadcast(df) if rows <= FEW else df


def written(df: DataFrame, path: str, keep: Column | None = None, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """Writes ``df`` (of it what ``keep`` says) as Parquet and returns the written table with ``counts``, aggregates that
    are observed on all of ``df`` in the one job of the write. A stage that Spark runs again after a lost executor may be
    observed twice; what the counts tell is a report, decisions are taken from tables."""
    seen = Observation()
    kept = df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(k) for k, c in ({"n": F.count(F.lit(1))} | counts).items()])
    (kept if keep is None else kept.where(keep)).write.mode("overwrite").parquet(path)
    found = {k: int(v or 0) for k, v in seen.get.items()}
    return df.sparkSession.read.schema(df.schema).parquet(path), {k: found.get(k, 0) for k in counts}


@dataclass
class Progress:
    """Where a run is: ``done`` of ``total`` items of a source, and its counts so far."""

    source: str
    done: int
    total: int
    counts: dict[str, int] = field(default_factory=dict)


def reporter(callback: Callable[[Progress], None] | None, source: str) -> Callable[[int, int, dict[str, int]], None]:
    """A caller of ``callback`` for one source. A callback that fails is logged and doesn't stop the run."""

    def report(done: int, total: int, counts: dict[str, int]) -> None:
        if callback is not None:
            try:
                callback(Progress(source, done, total, dict(counts)))
            except Exception:  # noqa: BLE001
                log.warning("the progress callback of %s failed", source, exc_info=True)

    return report


class StreamProgress(StreamingQueryListener):
    """Reports each batch of the streams of a session: rows read and what :meth:`DataFrame.observe` counts in them."""

    def __init__(self, callback: Callable[[Progress], None]):
        self.callback, self.done = callback, {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.done[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = event.progress
        key = str(p.id)
        self.done[key] = self.done.get(key, 0) + int(p.numInputRows)
        counts = {f"{name}.{k}": v for name, row in (p.observedMetrics or {}).items() for k, v in row.asDict().items()}
        reporter(self.callback, p.name or key)(self.done[key], self.done[key], counts)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.done.pop(str(event.id), None)
