"""All registered queries: name to (callable, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtflow.plans import (
    document_queries,
    flatten_queries,
    lineup_queries,
    write_queries,
)

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # timestamps are UTC throughout, whatever zone the session came with
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def registry() -> dict[str, tuple[Query, str | None]]:
    modules = (lineup_queries, document_queries, flatten_queries, write_queries)
    return {
        name: (_in_utc(query), sql)
        for module in modules
        for name, (query, sql) in module.QUERIES.items()
    }
