"""Change-data lake tables, data quality and sales analytics on Spark DataFrames."""

from .operators import LogTable
from .quality import Rule
from .specs import PRODUCTS, PRODUCTS_WIDE, SALES, TableSpec

__all__ = ["PRODUCTS", "PRODUCTS_WIDE", "SALES", "LogTable", "Rule", "TableSpec"]
