"""Sinks: CSV, JSON, reports, bulk load; a dry run writes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, columns: Sequence[str], dry_run: bool = False) -> int:
    """Columns in a fixed order under a header, nulls and absent ones as empty; returns the rows."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    if dry_run:
        return out.count()
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")
    return seen.get["n"]


def write_new_documents(docs: DataFrame, path: str, key: str, done: DataFrame | None = None) -> None:
    """Append documents that the manifest lacks, so that a rerun adds nothing."""
    fresh = docs if done is None else docs.join(done.select(key).distinct(), key, "left_anti")
    fresh.write.mode("append").json(path)


def set_sitting_numbers(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Documents with the number of their first listed file that has one; ``changed`` tells which differ."""
    from ..operators.joins import first_resolving

    named = docs.withColumn("_names", F.transform("source_files", lambda f: F.element_at(F.split(f, "/"), -1)))
    found = first_resolving(named, "path", "_names", numbers, "file_name", "numSeance").withColumnRenamed("numSeance", "_new")
    out = named.join(found, "path", "left")
    return out.withColumn("changed", F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("numSeance"))).withColumn("numSeance", F.coalesce("_new", "numSeance")).drop("_new", "_names")


def write_reports(reports: dict[str, DataFrame], folder: str, dry_run: bool = False) -> None:
    for name, df in reports.items():
        if not dry_run:
            df.write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def load_jdbc(tables: dict[str, DataFrame], url: str, properties: dict[str, str]) -> None:
    """Append tables to a database in the given order."""
    for name, df in tables.items():
        df.write.jdbc(url, name, mode="append", properties=properties)


def ddl(name: str, schema: str, key: Sequence[str] = ()) -> str:
    """A table's definition in ANSI SQL."""
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "double": "DOUBLE PRECISION", "boolean": "BOOLEAN"}
    lines = [f"  {f.name} {kinds.get(f.dataType.simpleString(), f.dataType.simpleString().upper())}" for f in T.StructType.fromDDL(schema)]
    return f"CREATE TABLE {name} (\n" + ",\n".join(lines + ([f"  PRIMARY KEY ({', '.join(key)})"] if key else [])) + "\n)"
