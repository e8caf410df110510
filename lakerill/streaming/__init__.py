"""Streaming jobs: ingest, periodic quality scans, throughput."""

from .ids import IdLedger, start_numbering
from .incremental import mergeable, rule_deltas, start_incremental_scan
from .ingest import EVERY_MINUTE, ingest_latency, read_broken, read_metrics, start_image_ingest, start_ingest, stream_id
from .latency import latency_quantiles, read_latency, start_timed_ingest
from .once import LateRecords, dropped_late, start_once_ingest
from .quality_scan import ClockedScan, PeriodicScan, last_scan, read_scans, scan_tables, start_quality_scan
from .retract import row_changes, running_sums
from .throughput import THROUGHPUT, end_feed, start_closed_throughput, start_throughput, throughput
from .views import SALES_VIEW, start_sales_view, view_daily, view_tiles

__all__ = [
    "EVERY_MINUTE",
    "SALES_VIEW",
    "THROUGHPUT",
    "ClockedScan",
    "IdLedger",
    "LateRecords",
    "PeriodicScan",
    "dropped_late",
    "end_feed",
    "ingest_latency",
    "last_scan",
    "latency_quantiles",
    "mergeable",
    "read_broken",
    "read_latency",
    "read_metrics",
    "read_scans",
    "row_changes",
    "rule_deltas",
    "running_sums",
    "scan_tables",
    "start_closed_throughput",
    "start_image_ingest",
    "start_incremental_scan",
    "start_ingest",
    "start_numbering",
    "start_once_ingest",
    "start_quality_scan",
    "start_sales_view",
    "start_throughput",
    "start_timed_ingest",
    "stream_id",
    "throughput",
    "view_daily",
    "view_tiles",
]
