"""Scans of files and tables, with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType) -> DataFrame:
    """CSV with a header and quoted texts over several lines."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All columns as strings, nulls as empty ones."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns])).na.fill("")


def read_years(spark: SparkSession, paths: dict[int, str], schema: str | T.StructType) -> DataFrame:
    """Yearly files with a ``source_year``; a missing file fails."""
    out = None
    for year, path in sorted(paths.items()):
        df = read_csv(spark, path, schema).withColumn("source_year", F.lit(year))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no years")
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Converted sittings, one JSON document a file."""
    return spark.read.schema(schemas.DOCUMENT).option("multiLine", True).option("pathGlobFilter", "speech_text_*.json").option("recursiveFileLookup", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def read_json_files(spark: SparkSession, path: str, wrapper: str) -> DataFrame:
    """One object a file as a variant, its wrapper key taken off; malformed files give null."""
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    whole = F.try_parse_json("value")
    return text.select(F.col("_metadata.file_path").alias("file"), F.coalesce(F.try_variant_get(whole, f"$.{wrapper}", "variant"), whole).alias("doc"))


def scalar(doc: Column, path: str) -> Column:
    """Text at a path; the object that stands for nil is null, ``#text`` is unwrapped."""
    return F.coalesce(F.try_variant_get(doc, f"{path}['#text']", "string"), F.when(F.schema_of_variant(F.try_variant_get(doc, path, "variant")).startswith("OBJECT"), None).otherwise(F.try_variant_get(doc, path, "string")))


def as_list(doc: Column, path: str, item: str = "variant") -> Column:
    """An array at a path, or the one value there as an array."""
    many = F.try_variant_get(doc, path, f"array<{item}>")
    one = F.try_variant_get(doc, path, item)
    return F.when(F.schema_of_variant(F.try_variant_get(doc, path, "variant")).startswith("ARRAY"), many).when(one.isNotNull(), F.array(one)).otherwise(F.array().cast(f"array<{item}>"))


def read_xml_files(spark: SparkSession, path: str, pattern: str = "CRI_*.xml") -> DataFrame:
    """Whole files as bytes with their path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "content")


def archive_links(links: DataFrame, base: str) -> DataFrame:
    """Distinct absolute links to archives."""
    href = F.col("href")
    url = F.when(href.rlike("^https?://"), href).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(href, "^/+", "")))
    return links.where(href.rlike(r"(?i)\.(taz|tar|tar\.gz|tgz)$")).select(url.alias("url")).distinct().orderBy("url")


def years_of(links: DataFrame) -> DataFrame:
    """Years that directory names are and archive names hold."""
    found = F.when(F.col("href").rlike(r"^(19|20)\d{2}/?$"), F.array(F.substring("href", 1, 4))).otherwise(F.regexp_extract_all("href", F.lit(r"(?:19|20)\d{2}"), F.lit(0)))
    return links.select(F.explode(found).cast("int").alias("year")).distinct().orderBy("year")


def links_of_year(root: DataFrame, by_year: DataFrame, year: int) -> DataFrame:
    """Root links that name a year, and the links of its own directory."""
    own = by_year.where(F.col("year") == year).select("url")
    return root.where(F.col("url").contains(str(year))).select("url").union(own).distinct().orderBy("url")
