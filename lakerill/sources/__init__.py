"""Reading tables and change feeds, and generating rows."""

from .changes import flatten_images, good_changes, image_schema, parse_images, read_changes, read_images
from .generators import (
    EVERY_TWO_MINUTES,
    digit_spine,
    number_spine,
    products_batch,
    products_stream,
    seed_products,
    seed_sales,
)
from .ids import assign_ids
from .snapshot import (
    chunk_bounds,
    chunk_counts,
    chunk_predicates,
    key_range,
    snapshot_by_chunks,
    snapshot_chunks,
    snapshot_options,
    snapshot_read,
)
from .tables import TABLES, read_table, register_tables, scan, stream_table

__all__ = [
    "EVERY_TWO_MINUTES",
    "TABLES",
    "assign_ids",
    "chunk_bounds",
    "chunk_counts",
    "chunk_predicates",
    "digit_spine",
    "flatten_images",
    "good_changes",
    "image_schema",
    "key_range",
    "number_spine",
    "parse_images",
    "products_batch",
    "products_stream",
    "read_changes",
    "read_images",
    "read_table",
    "register_tables",
    "scan",
    "seed_products",
    "seed_sales",
    "snapshot_by_chunks",
    "snapshot_chunks",
    "snapshot_options",
    "snapshot_read",
    "stream_table",
]
