"""Reading the application table and its optional side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.functions.numeric import sql_name

# Source names, and the types of the columns that feature code names; other columns of a
# CSV are read as they come
APPLICATION = "application"
SIDE_SOURCES = (
    "bureau",
    "bureau_balance",
    "previous_application",
    "credit_card_balance",
    "pos_cash_balance",
    "installments_payments",
)
KNOWN_TYPES = {
    **dict.fromkeys(("SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "MONTHS_BALANCE"), T.LongType()),
    "TARGET": T.IntegerType(),
    **dict.fromkeys(("STATUS", "CODE_GENDER", "FLAG_OWN_CAR"), T.StringType()),
    **dict.fromkeys(
        (
            "AMT_CREDIT",
            "AMT_INCOME_TOTAL",
            "AMT_ANNUITY",
            "AMT_GOODS_PRICE",
            "AMT_PAYMENT",
            "AMT_INSTALMENT",
            "EXT_SOURCE_1",
            "EXT_SOURCE_2",
            "EXT_SOURCE_3",
        ),
        T.DoubleType(),
    ),
    **dict.fromkeys(("DAYS_BIRTH", "DAYS_EMPLOYED"), T.LongType()),
}


def read_source(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet or CSV table. Without a schema CSV types are inferred, with the known columns pinned:
    ``STATUS`` mixes digits and letters and must stay text."""
    if not path.endswith((".csv", ".csv.gz")):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    # inference reads the whole file once more; pass a schema, or convert to Parquet, for large inputs
    guessed = reader.option("inferSchema", True).csv(path).schema
    fields = []
    for field in guessed.fields:
        kind = KNOWN_TYPES.get(field.name)
        if kind is None:
            kind = field.dataType if isinstance(field.dataType, T.NumericType) else T.StringType()
        fields.append(T.StructField(field.name, kind))
    return reader.schema(T.StructType(fields)).csv(path)


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _hadoop_path(spark, path)
    return files.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, files = _hadoop_path(spark, path)
    files.delete(target, True)


def fingerprint(spark: SparkSession, paths: dict[str, str]) -> dict[str, list]:
    """What files each source has now: (path under the source, bytes, time of change), by a listing alone."""
    found = {}
    for name, path in sorted(paths.items()):
        target, files = _hadoop_path(spark, path)
        if not files.exists(target):
            continue
        rows, listing = [], files.listFiles(target, True)
        root = files.getFileStatus(target).getPath().toString()
        while listing.hasNext():
            status = listing.next()
            own = status.getPath().toString().removeprefix(root)
            if not status.getPath().getName().startswith(("_", ".")):
                rows.append([own, status.getLen(), status.getModificationTime()])
        found[name] = sorted(rows)
    return found


def content_digest(df: DataFrame) -> tuple[int, str]:
    """Rows, and a sum of row hashes: the same in any order and partitioning."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return row["n"], str(row["h"] or 0)


def read_sources(
    spark: SparkSession,
    paths: dict[str, str],
    required: tuple[str, ...] = (APPLICATION,),
    schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """All sources that are named and exist. A missing optional source is left out."""
    schemas = schemas or {}
    found = {}
    for name, path in paths.items():
        if name in required or exists(spark, path):
            found[name] = read_source(spark, path, schemas.get(name))
    for name in required:
        if name not in found:
            raise ValueError(f"source {name!r} is required")
    return found


def nan_to_null(df: DataFrame) -> DataFrame:
    """avg and max keep NaN, the semantics wanted is to skip it: make it NULL at the scan."""
    out = []
    for f in df.schema.fields:
        name = sql_name(f.name)
        is_float = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        out.append(f"nullif(double({name}), double('NaN')) AS {name}" if is_float else name)
    return df.selectExpr(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """A result table with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
