"""File trees: log text, landed JSON lines, Parquet tables and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obslake.functions.shapes import ddl, type_of_shape
from obslake.session import new_shared_path
from obslake.sinks.paths import exists
from obslake.sinks.shapes import read_kept

EXTERNAL_PARTITIONS = T.StructType([T.StructField("_source_api", T.StringType()), T.StructField("_date", T.DateType())])

# Columns of a landing tree without readable lines.
LANDED = T.StructType(
    [T.StructField("_source_api", T.StringType()), T.StructField("_received_at", T.LongType()), T.StructField("_data", T.StringType())]
)
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_RECURSIVE = {"recursiveFileLookup": "true"}


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of every file below ``path``; directory names become no columns."""
    return spark.read.options(**_RECURSIVE).text(path)


def _staged(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Every line below ``path`` parsed once: ``value`` (variant, null for bad JSON) per ``source`` folder, and where it is."""
    lines = read_log_text(spark, path).where(F.trim("value") != "")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/source=([^/]*)/", 1)
    parsed = lines.select(F.try_parse_json("value").alias("value"), F.concat(F.lit("s-"), folder).alias("source"))
    where = new_shared_path(spark, "parsed")
    parsed.write.partitionBy("source").parquet(where)
    return spark.read.schema("value variant, source string").parquet(where), where


def _shaped(rows: DataFrame, shape: str | None) -> DataFrame:
    kind = type_of_shape(shape)
    kind = kind if isinstance(kind, T.StructType) else LANDED
    typed = F.try_variant_get("value", "$", ddl(kind))
    return rows.select(typed.alias("row")).select("row.*")


def read_external_ndjson(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Landed JSON lines below ``path``.

    Without ``schema`` the lines are parsed once, into variants that are kept in the shared
    folder; their shape is an aggregate over those, and the columns are taken from them.  A line
    that is no JSON is a row of nulls.  Fractions are doubles, a field with values of several
    kinds is text, and so is one that is null throughout.
    """
    if schema is not None:
        return spark.read.options(**_RECURSIVE).option("multiLine", "false").schema(schema).json(path)
    rows, _ = _staged(spark, path)
    return _shaped(rows, rows.agg(F.schema_of_variant_agg("value").alias("shape")).first()["shape"])


def read_external_sources(spark: SparkSession, path: str) -> list[DataFrame]:
    """Landed JSON lines below ``path``, a DataFrame for each ``source=`` folder, with the shape of its own lines.

    All sources are parsed by one job and their shapes found by another; only names and shapes
    reach the driver.
    """
    rows, where = _staged(spark, path)
    shapes = rows.groupBy("source").agg(F.schema_of_variant_agg("value").alias("shape")).orderBy("source").collect()
    return [_shaped(spark.read.schema("value variant").parquet(f"{where}/source={r['source']}"), r["shape"]) for r in shapes]


def read_external_table(spark: SparkSession, path: str) -> DataFrame:
    """Structured external rows written over several runs, with the union of their columns.

    The columns and types come from what the writers kept; a column that changed its type is read
    as the widest number, or as text.
    """
    return read_kept(spark, path, EXTERNAL_PARTITIONS)


def list_data_files(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Parquet files below ``root`` whose relative name starts with ``prefix``.

    The prefix is matched as text and need not end at a directory; blank means all.
    File contents are not read.
    """
    base = root.rstrip("/")
    prefix = prefix if prefix and prefix.strip() else ""
    # Only the folder the prefix points into is listed.
    folder = "/".join([base, *prefix.split("/")[:-1]])
    reader = spark.read.format("binaryFile").options(**_RECURSIVE)
    found = reader.load(folder) if exists(spark, folder) else reader.schema(_FILES).load([])
    anchor = base.split("://", 1)[-1] if "://" in base else base.removeprefix("file:")
    name = F.substring("path", F.locate(anchor, F.col("path")) + F.lit(len(anchor) + 1), F.length("path"))
    out = found.select("path", "length", "modificationTime", name.alias("name"))
    return out.filter(F.col("name").endswith(".parquet") & F.col("name").startswith(prefix))
