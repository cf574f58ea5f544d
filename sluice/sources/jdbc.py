"""Options for Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.durations import parse_millis


@dataclass(frozen=True)
class JdbcSettings:
    """Where and how to connect; ``properties`` go to the driver as they are."""

    url: str
    user: str
    password: str
    driver: str | None = None
    statement_limit: str = "0 seconds"
    properties: dict[str, str] = field(default_factory=dict)


def jdbc_options(
    settings: JdbcSettings,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """The option map of ``format("jdbc")`` for one table or one query.

    With a partition column, its bounds and a partition count the rows are read
    by that many tasks; the bounds only place the cuts and drop no row.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    own = {"url", "user", "password", "driver", "dbtable", "query", "queryTimeout"}
    clash = sorted(own & settings.properties.keys())
    if clash:
        raise ValueError(f"already set by a named setting: {', '.join(clash)}")
    out = dict(settings.properties)
    out.update(url=settings.url, user=settings.user, password=settings.password)
    if settings.driver:
        out["driver"] = settings.driver
    out["queryTimeout"] = str(parse_millis(settings.statement_limit) // 1000)
    given = [partition_column is not None, bounds is not None, partitions is not None]
    if any(given):
        if not all(given):
            raise ValueError("partition_column, bounds and partitions go together")
        # A partitioned read needs a table expression; the source refuses "query" for it.
        out["dbtable"] = table if table is not None else f"({query}) q"
        out["partitionColumn"] = partition_column
        out["lowerBound"], out["upperBound"] = bounds
        out["numPartitions"] = str(partitions)
    elif table is not None:
        out["dbtable"] = table
    else:
        out["query"] = query
    return out


def read_jdbc(spark: SparkSession, settings: JdbcSettings, **what) -> DataFrame:
    """Rows of a table or query; filters and column choice are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(settings, **what)).load()
