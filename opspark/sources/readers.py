"""Readers for tables, logs, reports and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from opspark.sources import schemas


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True,
             timestamp_format: str | None = None) -> DataFrame:
    """CSV with a given schema; unreadable fields become null, whole bad lines go to ``_corrupt`` if declared."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
    if "_corrupt" in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt")
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """Headerless prediction log; a stray header line has no readable time and is dropped."""
    return read_csv(spark, path, schemas.PREDICTION_LOG, header=False).where("ts is not null")


def read_feature_history(spark: SparkSession, path: str, schema: StructType = schemas.DRIVER_STATS) -> DataFrame:
    """Feature rows with ISO ``Z`` event times."""
    return read_csv(spark, path, schema, timestamp_format="yyyy-MM-dd'T'HH:mm:ssX")


def read_cost_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Cost rows; the malformed summary line is left out."""
    sheet = read_csv(spark, path, schemas.COST_SHEET)
    return sheet.where("MonthlyHours is not null and CostPerHourUSD is not null").drop("_corrupt")


def _files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths in a folder ending with the suffix, through the Hadoop file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().endswith(suffix))


def read_folder(spark: SparkSession, folder: str, csv_schema: StructType | None = None) -> DataFrame:
    """All CSV files of a folder or, where there are none, all Parquet files; an empty folder is an error."""
    found = _files(spark, folder, ".csv")
    if found:
        if csv_schema is None:
            return spark.read.option("header", True).option("inferSchema", True).csv(found)
        return read_csv(spark, found, csv_schema)
    found = _files(spark, folder, ".parquet")
    if found:
        return spark.read.parquet(*found)
    raise FileNotFoundError(f"no data files found in {folder}")


def read_latest_batch(spark: SparkSession, folder: str) -> DataFrame | None:
    """The Parquet batch last in name order, or None when there is none."""
    found = _files(spark, folder, ".parquet")
    return spark.read.parquet(found[-1]) if found else None


def read_with_target(spark: SparkSession, features: str, target: str, key: str) -> DataFrame:
    """Feature and target tables joined on their key."""
    return spark.read.parquet(features).join(spark.read.parquet(target), key)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Nested compliance reports; missing totals become zero."""
    report = spark.read.schema(schemas.COMPLIANCE_REPORT).option("multiLine", True).json(path)
    names = ("total_pass", "total_fail", "total_warn", "total_info")
    return report.select(*[F.coalesce(f"Totals.{n}", F.lit(0)).alias(n) for n in names], "Controls")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines as ``value``."""
    return spark.read.text(path)


def message_stream(spark: SparkSession, source: str, **options) -> DataFrame:
    """Unbounded messages as a ``value`` text column.

    ``source="kafka"`` reads a topic from the latest offset; ``source="files"``
    follows a folder of JSON lines given as ``path``.
    """
    if source == "kafka":
        reader = spark.readStream.format("kafka").option("startingOffsets", options.pop("startingOffsets", "latest"))
        for name, value in options.items():
            reader = reader.option(name.replace("__", "."), value)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "files":
        reader = spark.readStream.option("maxFilesPerTrigger", options.get("maxFilesPerTrigger", 1000))
        return reader.text(options["path"])
    raise ValueError(f"unknown message source: {source}")


def parse_readings(messages: DataFrame, schema: StructType = schemas.SENSOR_READING) -> DataFrame:
    """JSON messages as columns plus ``ok``: every field present and readable."""
    parsed = messages.withColumn("_r", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    present = F.col("_r").isNotNull()
    for name in schema.fieldNames():
        present = present & F.col(f"_r.{name}").isNotNull()
    rest = [F.col(c) for c in messages.columns if c != "value"]
    return parsed.select(*rest, F.col("value").alias("message"), F.coalesce(present, F.lit(False)).alias("ok"), "_r.*")


def accepted(parsed: DataFrame) -> DataFrame:
    """The readable messages."""
    return parsed.where("ok").drop("ok", "message")


def rejected(parsed: DataFrame) -> DataFrame:
    """The dead letters: messages with a missing or unreadable field."""
    return parsed.where("not ok").select("message")
