"""Catalog operations.

Views are registered as temporary views when no catalog is given, else as
catalog views carrying their comment.  Dropping is explicit and defaults to a
dry run that only reports what would be dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RESULT_SCHEMA = T.StructType([
    T.StructField("object_name", T.StringType(), False),
    T.StructField("action", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
])


def section_view(df: DataFrame, section: str, name: str,
                 section_col: str = "dashboard_section") -> DataFrame:
    """S3: a temp view holding one section of a long table.

    The filter lives inside the view, so queries over it push the section
    predicate (and their own) down to the scan.  For a persistent view with
    a comment on a real catalog use ``register_catalog_view``.
    """
    df.filter(F.col(section_col) == F.lit(section)).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def register_catalog_view(spark: SparkSession, name: str, source_table: str,
                          section: str | None = None, comment: str | None = None,
                          section_col: str = "dashboard_section") -> None:
    """S3/S4 on a real catalog: CREATE OR REPLACE VIEW ... COMMENT ... AS SELECT."""
    where = ""
    if section is not None:
        safe = section.replace("'", "''")
        where = f" WHERE {section_col} = '{safe}'"
    cmt = ""
    if comment is not None:
        cmt = " COMMENT '" + comment.replace("'", "''") + "'"
    spark.sql(f"CREATE OR REPLACE VIEW {name}{cmt} AS SELECT * FROM {source_table}{where}")


def section_views(df: DataFrame, sections: Iterable[str], prefix: str = "v_",
                  section_col: str = "dashboard_section") -> dict[str, str]:
    """Register one temp view per section; returns view name by section."""
    names = {}
    for s in sections:
        name = f"{prefix}{s}"
        df.filter(F.col(section_col) == F.lit(s)).createOrReplaceTempView(name)
        names[s] = name
    return names


def passthrough_view(df: DataFrame, name: str) -> None:
    """Dimension passthrough view."""
    df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a schema as a frame, names lower-cased."""
    rows = [(t.name.lower(), t.tableType, bool(t.isTemporary), t.description)
            for t in spark.catalog.listTables(database)]
    schema = T.StructType([
        T.StructField("table_name", T.StringType(), False),
        T.StructField("table_type", T.StringType(), True),
        T.StructField("is_temporary", T.BooleanType(), True),
        T.StructField("description", T.StringType(), True),
    ])
    return spark.createDataFrame(rows, schema)


def schema_exists(spark: SparkSession, name: str) -> bool:
    """Exact-name test (a longer name containing ``name`` does not count)."""
    return spark.catalog.databaseExists(name)


def existing(spark: SparkSession, names: Iterable[str], database: str | None = None) -> dict[str, bool]:
    """Existence of each named table, for SKIPPED/MISSING status rows."""
    return {n: spark.catalog.tableExists(n, database) for n in names}


def retire_tables(spark: SparkSession, names: Iterable[str], dry_run: bool = True) -> DataFrame:
    """DROP TABLE IF EXISTS over an explicit list, one result row per name."""
    out = []
    for n in names:
        present = spark.catalog.tableExists(n)
        if not present:
            out.append((n, "drop", "ABSENT"))
        elif dry_run:
            out.append((n, "drop", "WOULD_DROP"))
        else:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
            out.append((n, "drop", "DROPPED"))
    return spark.createDataFrame(out, _RESULT_SCHEMA)


def preview(df: DataFrame, rows: int = 60, width: int = 45) -> None:
    """Bounded console preview (NULL shown as NULL)."""
    df.show(rows, truncate=width)


def listing(df: DataFrame, section: str, columns: list[str], order: list[str],
            section_col: str = "dashboard_section") -> DataFrame:
    """Project + section filter + sort."""
    return df.filter(F.col(section_col) == F.lit(section)).select(*columns).orderBy(*order)
