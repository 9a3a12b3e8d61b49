"""Table access (S1): one API over parquet folders and catalog tables."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy table loader.

    ``Tables(spark, "/data/sf1")`` reads ``/data/sf1/<name>.parquet``;
    ``Tables(spark, catalog="cat.schema")`` reads ``cat.schema.<name>``.
    Nothing is scanned until an action; Catalyst prunes columns and pushes
    filters into the parquet scan for whatever the caller selects.
    """

    def __init__(self, spark: SparkSession, root: str | None = None,
                 catalog: str | None = None):
        if (root is None) == (catalog is None):
            raise ValueError("give exactly one of root or catalog")
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.catalog = catalog

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if self.root is not None:
            return self.spark.read.parquet(self.path(name))
        return self.spark.table(f"{self.catalog}.{name}")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)


TABLE_PREFIX = "table:"
#: Schemas that a session has read, by path. A file that is added later is read with the columns known then.
_SCHEMAS: weakref.WeakKeyDictionary[SparkSession, dict] = weakref.WeakKeyDictionary()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` under a root: a folder of ``<name>.parquet`` files, or
    ``table:<database>`` for catalog tables (e.g. bucketed copies, see
    ``sources.layout``)."""
    if sf_dir.startswith(TABLE_PREFIX):
        return spark.table(f"{sf_dir[len(TABLE_PREFIX):]}.{name}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schemas = _SCHEMAS.setdefault(spark, {})
    if path not in schemas:
        schemas[path] = spark.read.parquet(path).schema
    # the files are listed anew, so appended ones are read; only their footers aren't opened again
    return spark.read.schema(schemas[path]).parquet(path)
