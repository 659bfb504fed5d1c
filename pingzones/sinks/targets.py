"""Targets that labelled pings are appended to: a path, a catalog table, JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingzones.functions.parsing import ntz
from pingzones.operators.shared_folder import path_exists
from pingzones.schema import OUTPUT_SCHEMA

TIME = "fecha_hora"
BATCH_SIZE = 5000


def latest_time(df: DataFrame, column: str = TIME) -> DataFrame:
    """One row ``max_ts``, null for an empty table."""
    return df.agg(F.max(column).alias("max_ts"))


def latest_time_of_files(df: DataFrame, column: str = TIME) -> DataFrame:
    """``latest_time`` of a file table without reading the whole column.

    The files written last give a time that is probably the latest.  Whether any
    row is later is then a filter that file and row-group statistics answer, so
    old files are skipped.  The result is exact whatever the files hold.
    """
    modified = F.unix_micros("_metadata.file_modification_time")
    newest = df.agg(F.max(modified).alias("t")).first()["t"]
    guess = None
    if newest is not None:
        guess = latest_time(df.filter(modified == F.lit(newest)), column).first()["max_ts"]
    if guess is None:
        return latest_time(df, column)
    later = df.filter(F.col(column) > ntz(guess))
    return later.agg(F.coalesce(F.max(column), ntz(guess)).alias("max_ts"))


class Conflict(Exception):
    """Another writer changed the target meanwhile; nothing was written."""


@dataclass
class Snapshot:
    """A target as a cycle found it, for the append that ends the cycle."""

    target: Target
    mark: datetime | None

    def append(self, df: DataFrame) -> None:
        """Append; targets that can tell raise Conflict if they have changed since."""
        self.target.append(df)


class Target:
    """What a load cycle needs from a target."""

    spark: SparkSession

    def exists(self) -> bool:
        raise NotImplementedError

    def read(self) -> DataFrame:
        raise NotImplementedError

    def append(self, df: DataFrame) -> None:
        raise NotImplementedError

    def replace(self, df: DataFrame) -> None:
        raise NotImplementedError

    def high_water_mark(self) -> datetime | None:
        """Latest loaded time; None for a missing or empty target."""
        if not self.exists():
            return None
        return latest_time(self.read()).first()["max_ts"]

    def snapshot(self) -> Snapshot:
        return Snapshot(self, self.high_water_mark())

    def append_once(self, df: DataFrame, stream: str, number: int) -> bool | None:
        """Append batch ``number`` of a stream and say so, unless it is there; None if the target cannot tell."""
        return None


@dataclass
class PathTarget(Target):
    """Parquet files under a path."""

    spark: SparkSession
    path: str
    schema: object = OUTPUT_SCHEMA

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def high_water_mark(self) -> datetime | None:
        return latest_time_of_files(self.read()).first()["max_ts"] if self.exists() else None

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)

    def replace(self, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path)


@dataclass
class TableTarget(Target):
    """A table of the session catalog or of another configured catalog.

    With a JDBC catalog (``jdbc_catalog_conf``) existence is asked of the
    database, and the maximum in ``high_water_mark`` is computed there.
    """

    spark: SparkSession
    name: str
    provider: str = "parquet"

    def _in_session_catalog(self) -> bool:
        return self.name.count(".") < 2 or self.name.startswith("spark_catalog.")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        if self._in_session_catalog():
            df.write.mode("append").format(self.provider).saveAsTable(self.name)
        elif self.exists():
            df.writeTo(self.name).append()
        else:
            df.writeTo(self.name).create()

    def replace(self, df: DataFrame) -> None:
        if self._in_session_catalog():
            df.write.mode("overwrite").format(self.provider).saveAsTable(self.name)
        else:
            df.writeTo(self.name).createOrReplace()


def jdbc_catalog_conf(catalog: str, url: str, driver: str, **options: str) -> dict[str, str]:
    """Session settings that make a database available as catalog ``catalog``."""
    prefix = f"spark.sql.catalog.{catalog}"
    conf = {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": url,
        f"{prefix}.driver": driver,
        f"{prefix}.pushDownAggregate": "true",
        f"{prefix}.preferTimestampNTZ": "true",
    }
    return conf | {f"{prefix}.{k}": v for k, v in options.items()}


@dataclass
class JdbcTarget(Target):
    """A database table written over ``connections`` parallel connections.

    The column types of a table that the write creates are those of Spark's
    dialect for the database.  Whether the table exists is asked of the catalog
    if ``catalog_name`` is its name in a JDBC catalog, and else of the
    database's information schema.
    """

    spark: SparkSession
    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 16
    catalog_name: str | None = None

    def _query(self, sql: str) -> DataFrame:
        return (
            self.spark.read.format("jdbc")
            .options(url=self.url, query=sql, preferTimestampNTZ="true", **self.properties)
            .load()
        )

    def exists(self) -> bool:
        if self.catalog_name is not None:
            return self.spark.catalog.tableExists(self.catalog_name)
        *schema, name = [part.strip('"').replace("'", "''") for part in self.table.split(".")]
        where = f"lower(table_name) = lower('{name}')"
        if schema:
            where += f" AND lower(table_schema) = lower('{schema[-1]}')"
        return self._query(f"SELECT COUNT(*) AS n FROM information_schema.tables WHERE {where}").first()[0] > 0

    def read(self) -> DataFrame:
        return (
            self.spark.read.format("jdbc")
            .options(url=self.url, dbtable=self.table, preferTimestampNTZ="true", **self.properties)
            .load()
        )

    def high_water_mark(self) -> datetime | None:
        if not self.exists():
            return None
        return self._query(f"SELECT MAX({TIME}) AS max_ts FROM {self.table}").first()[0]

    def _write(self, df: DataFrame, mode: str) -> None:
        # Only the insert is narrow; the labelling before it keeps its own tasks.
        (
            df.repartition(self.connections)
            .write.format("jdbc")
            .mode(mode)
            .options(
                url=self.url,
                dbtable=self.table,
                batchsize=str(BATCH_SIZE),
                numPartitions=str(self.connections),
                **self.properties,
            )
            .save()
        )

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def replace(self, df: DataFrame) -> None:
        self._write(df, "overwrite")
