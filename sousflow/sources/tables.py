"""Tables of one data location: a directory of parquet files or a catalog namespace.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so a
job that uses two columns reads two columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, "/data/sf1")`` reads ``/data/sf1/<name>.parquet`` (or a
    ``<name>`` directory); ``Tables.catalog(spark, "db.schema")`` reads catalog tables
    ``db.schema.<name>`` (any catalog Spark is configured with)."""

    def __init__(self, spark: SparkSession, root: str, *, namespace: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def catalog(cls, spark: SparkSession, namespace: str) -> Tables:
        return cls(spark, "", namespace=namespace)

    @classmethod
    def across(cls, spark: SparkSession, namespaces: Mapping[str, Sequence[str]]) -> Tables:
        """Tables of several catalog namespaces under one roof: namespace -> the names it holds."""
        roof = cls(spark, "", namespace="")
        for namespace, names in namespaces.items():
            roof._frames.update({name: spark.table(f"{namespace}.{name}") for name in names})
        return roof

    def _read(self, name: str) -> DataFrame:
        """``<root>/<name>.parquet`` or else ``<root>/<name>``; Spark's own file system says which is there."""
        try:
            return self.spark.read.parquet(f"{self.root}/{name}.parquet")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.read.parquet(f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame; one reader per name and ``Tables`` (footer read once).

        A reader lists the files that are there when it is made; a new ``Tables`` sees files appended since.
        """
        if name not in self._frames:
            self._frames[name] = (self.spark.table(f"{self.namespace}.{name}") if self.namespace is not None
                                  else self._read(name))
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


def register_external(spark: SparkSession, namespace: str, root: str, names: Sequence[str], folder: str | None = None) -> None:
    """Make ``<root>/<name>.parquet`` known to the session's catalog as ``namespace.name``; the files stay where they are.

    ``folder`` is the namespace's own location (nothing is written there), else the warehouse.
    """
    place = f" LOCATION '{folder}/{namespace}.db'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{place}")
    for name in names:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} USING parquet LOCATION '{root.rstrip('/')}/{name}.parquet'")
