"""The raw landing zone: hour folders of JSON files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.times import column
from ..schemas import RAW

# Time stamps inside object names, down to the second or the hour.
PATH_TO_SECOND = r"(\d{4})/(\d{2})/(\d{2})/(\d{2})/(\d{2})/(\d{2})"
PATH_TO_HOUR = r"(\d{4})/(\d{2})/(\d{2})/(\d{2})"


CORRUPT = "_corrupt"


def hour_folder(root: str, entity: str, hour: datetime) -> str:
    return f"{root.rstrip('/')}/{entity}/{hour:%Y/%m/%d/%H}"


def _raw_lines(
    spark: SparkSession, root: str, entity: str, hour: datetime | None, schema: StructType | None
) -> DataFrame:
    fields = (schema or RAW[entity]).fields
    reader = spark.read.schema(StructType([*fields, StructField(CORRUPT, StringType())]))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    folder = f"{root.rstrip('/')}/{entity}" if hour is None else hour_folder(root, entity, hour)
    rows = reader.option("recursiveFileLookup", True).json(folder)
    # Spark refuses to read the broken text alone, so a field is always looked at as well
    return rows.where(F.length(F.concat_ws("", F.col(fields[0].name).cast("string"))) >= 0)


def raw_json_read(
    spark: SparkSession,
    root: str,
    entity: str,
    hour: datetime | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Records of one hour folder, or of the whole tree of an entity.

    A line may hold one record or an array of records. The schema is always
    given, so no pass over the files is spent on guessing it. Broken lines are no
    records; :func:`raw_json_rejects` has them.
    """
    rows = _raw_lines(spark, root, entity, hour, schema)
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def raw_json_rejects(
    spark: SparkSession,
    root: str,
    entity: str,
    hour: datetime | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The lines that :func:`raw_json_read` leaves out, as ``line`` with their ``path``.

    Not only what is no JSON, also lines with a value that its column cannot hold.
    """
    rows = _raw_lines(spark, root, entity, hour, schema)
    return rows.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("path")
    )


def path_timestamp(path: Column | str) -> Column:
    """Time named by an object path: to the second if it goes that far, else to the hour."""
    p = column(path)

    def part(pattern: str, n: int) -> Column:
        return F.regexp_extract(p, pattern, n).cast("int")

    def stamp(pattern: str, parts: int) -> Column:
        fields = [part(pattern, i + 1) if i < parts else F.lit(0) for i in range(6)]
        return F.when(p.rlike(pattern), F.try_make_timestamp(*fields))

    return F.coalesce(stamp(PATH_TO_SECOND, 6), stamp(PATH_TO_HOUR, 4))


def latest_path_partition(paths: DataFrame, path: str = "path") -> DataFrame:
    """One row with the newest time named by the paths; NULL when none names any."""
    return paths.agg(F.max(path_timestamp(path)).alias("latest"))


def object_paths(spark: SparkSession, root: str) -> DataFrame:
    """One row per file under a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime")
    )


def json_topic_decode(
    messages: DataFrame, schema: StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Message text or bytes to typed columns: (good rows, broken messages).

    Works on batches and streams; broken messages keep their text.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = messages.withColumn(
        "_record",
        F.from_json(
            F.col(value).cast("string"),
            with_corrupt,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ),
    )
    broken = F.col("_record").isNull() | F.col(f"_record.{CORRUPT}").isNotNull()
    others = [c for c in messages.columns if c != value]
    good = parsed.where(~broken).select(*others, *[f"_record.{n}" for n in schema.names])
    return good, parsed.where(broken).select(*others, F.col(value).cast("string").alias(value))
