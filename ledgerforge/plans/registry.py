"""The queries by name, each with its SQL (none where SQL cannot express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerforge.fixtures import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(tables: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; ``sql`` reads the named logical tables."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_tables(tables, sql) if tables else sql
        return f

    return put


#: DuckDB has no crc32: its table by the rule of the polynomial, then byte by byte.
CRC_TABLE = "(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"


def crc32_sql(text: str) -> str:
    """SQL of the unsigned crc32 of a text's UTF-8 bytes, in a query that reads ``CRC_TABLE`` too."""
    code = f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda i: CAST('0x' || hex(encode({text}))[i:i + 1] AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {code}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"
