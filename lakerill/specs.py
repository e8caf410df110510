"""Table definitions: payload schema, key and change order of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Columns every change record carries before its payload.
CHANGE_META = T.StructType(
    [
        T.StructField("op", T.StringType()),  # 'c' insert, 'u' update, 'd' delete
        T.StructField("seq", T.LongType()),  # total order of the changes of a table
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

DELETE = "d"


@dataclass(frozen=True)
class TableSpec:
    """A keyed table. ``order`` names the columns that decide which change is newer.

    ``defaults`` gives the value, as an SQL literal, that a column has in files written before the table had it; Spark's readers fill
    it in. A NULL that was written stays NULL.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    order: tuple[str, ...] = ("seq",)
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def change_schema(self) -> T.StructType:
        """Schema of a change record: ``op, seq, ts`` and the after-image."""
        own = [self._with_default(f) for f in self.schema.fields if f.name not in CHANGE_META.fieldNames()]
        return T.StructType(CHANGE_META.fields + own)

    def _with_default(self, f: T.StructField) -> T.StructField:
        if f.name not in self.defaults:
            return f
        return T.StructField(f.name, f.dataType, f.nullable, {"EXISTS_DEFAULT": self.defaults[f.name]})


def schema_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


INT, BIGINT, STRING, DOUBLE = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
MONEY, TIMESTAMP, BOOLEAN = T.DecimalType(10, 2), T.TimestampNTZType(), T.BooleanType()

PRODUCTS = TableSpec("products", schema_of(id=INT, sku=STRING, name=STRING), ("id",))

PRODUCTS_WIDE = TableSpec(
    "products", schema_of(id=INT, sku=STRING, name=STRING, price=MONEY, created_at=TIMESTAMP), ("id",)
)

SALES = TableSpec(
    "sales", schema_of(id=BIGINT, product_id=INT, qty=INT, price=MONEY, sale_ts=TIMESTAMP), ("id",)
)

#: PRODUCTS_WIDE for a table that began with the three columns of PRODUCTS.
PRODUCTS_GROWN = TableSpec(
    "products",
    PRODUCTS_WIDE.schema,
    ("id",),
    defaults={"price": "CAST(0.00 AS DECIMAL(10,2))", "created_at": "TIMESTAMP_NTZ'2024-01-01 00:00:00'"},
)
