"""Wide tables of audiences: all columns of the wide table for an audience's ids, stored as ORC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(audience: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """wide.* for each audience row with a filled id; multiplicity is kept."""
    ids = audience.filter(F.col(key).isNotNull() & (F.col(key) != "")).select(key)
    return wide.join(ids, key).select(*wide.columns)


def distinct_rows(joined: DataFrame) -> DataFrame:
    return joined.distinct()


def save_orc(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """The table, which is made of df if it isn't there; path: where its files are to be."""
    if not df.sparkSession.catalog.tableExists(table):
        writer = df.write.format("orc").mode("ignore")
        (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
