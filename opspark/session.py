"""Session helpers: settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Row bound under which a side may be broadcast (checked, never assumed).
BROADCAST_ROWS = 500_000

#: Bytes under which it may be, where rows hold texts or nested values.
BROADCAST_BYTES = 128 << 20

#: Bound on rows that may be brought to the driver as fitted state.
DRIVER_ROWS = 100_000


def tune(spark: SparkSession) -> SparkSession:
    """Set the session options the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cpus: int | str = 8, app: str = "opspark", **conf) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus if cpus != "*" else 8))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


#: The scratch folder of each running application; ``spark.checkpoint.dir`` itself can't be set on a running session.
_SCRATCH: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under the one that ``spark.checkpoint.dir`` names; it is removed when the application ends.

    Only a local master may fall back to a temporary folder; on a cluster a
    missing setting is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    application = spark.sparkContext.applicationId
    if application not in _SCRATCH:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            base = tempfile.mkdtemp(prefix="opspark-checkpoint-")
        folder = f"{base.rstrip('/')}/opspark-{application}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH[application] = folder
    return _SCRATCH[application]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    The table outlives executors and carries its size, so later joins are planned on facts.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share rows evenly when there are fewer input splits than cores.

    For costly row-local work on small inputs; a large input already has more
    splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row, about: eight for a plain value, the length of a text, the length as text of anything nested."""
    total = F.lit(0)
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(col)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(col)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is counted to hold at most so many rows and bytes."""
    if df.limit(rows + 1).count() > rows:
        return False
    if all(not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields):
        return True
    return (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= size


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when ``df`` is counted to hold at most ``rows`` rows, and ``BROADCAST_BYTES`` bytes.

    Beyond the bounds the frame is returned as it is, so the join stays a
    shuffle join that adaptive execution may split on skew.
    """
    return F.broadcast(df) if fits(df, rows) else df


def small_rows(df: DataFrame, bound: int = DRIVER_ROWS) -> list:
    """Collect a fitted-state frame, refusing anything above ``bound`` rows."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} rows of fitted state")
    return rows
