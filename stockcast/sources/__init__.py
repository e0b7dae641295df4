"""Sources and sinks: the sales table from CSV or from star-schema tables."""

from stockcast.sources.star import StarSales, sales_from_star
from stockcast.sources.csv_sales import CsvSales, read_sales

__all__ = ["StarSales", "sales_from_star", "CsvSales", "read_sales"]
