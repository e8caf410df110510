"""Replay removal in a stream, with what came too late counted."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.lake import LogTable
from ..operators.state import dedup
from .ingest import start_ingest


def dropped_late(query: StreamingQuery) -> int:
    """Records that a stream's stateful operators left out so far because they came after the watermark.

    Spark keeps the progress of the last hundred batches; for a longer run register a :class:`LateRecords` before the start.
    """
    return sum(_dropped(p) for p in query.recentProgress)


def _dropped(progress: Any) -> int:
    return sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])


class LateRecords(StreamingQueryListener):
    """Adds up the late records of all batches of each query; give it to ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event: Any) -> None:
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event: Any) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        query = str(event.progress.id)
        self.by_query[query] = self.by_query.get(query, 0) + late

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


def start_once_ingest(
    changes: DataFrame, table: LogTable, checkpoint: str, lateness: str, trigger: Mapping[str, Any]
) -> StreamingQuery:
    """Write each change ``(key, seq)`` of a stream that delivers some of them again, once, into ``table``.

    The state store remembers a change for ``lateness`` of event time, so it holds that stretch of the feed and no more. A copy in
    the same or a later batch is left out. What comes later than the watermark (the newest event time less ``lateness``, as
    of the batch before the last) can no longer be told from a copy: it is left out too, and counted (``dropped_late``).
    """
    return start_ingest(dedup(changes, table.spec.key, lateness=lateness), table, checkpoint, trigger)
