"""Files: delimited text, JSON, tables with versions, and what is written."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.text import org_key, without_placeholder


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A file with a header, every column as text (leading zeros stay). FileNotFoundError without the file.

    With ``columns`` these are the schema, so that the file isn't read to find it.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", True).option("escape", '"')
    if columns:
        return reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path)
    return reader.csv(path)


#: The columns of the hospital file.
HOSPITAL_COLUMNS = {"Facility ID": "source_id", "Facility Name": "name", "Address": "address", "City/Town": "city", "State": "state", "ZIP Code": "zip", "Telephone Number": "phone"}


def hospitals_from_csv(rows: DataFrame) -> DataFrame:
    """The hospital file as organizations; placeholder cells are NULL, names only trimmed, their key folded."""
    read = rows.select(*[without_placeholder(F.col(f"`{c}`"), "cms").alias(n) for c, n in HOSPITAL_COLUMNS.items()])
    return read.where("name is not null").withColumn("normalized_name", org_key(F.col("name"))).withColumns({"source": F.lit("CMS"), "organization_type": F.lit("hospital")})


def read_json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON records of a schema; an absent file or unreadable lines give no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    read = spark.read.schema(T.StructType.fromDDL(schema).add("_bad", "string")).option("columnNameOfCorruptRecord", "_bad").json(path)
    return read.where("_bad is null").drop("_bad")


def current_download(metadata: str) -> str:
    """The download address in a dataset's metadata (JSON text); RuntimeError if it has none."""
    import json

    try:
        found = [d["downloadURL"] for d in json.loads(metadata)["distribution"] if d.get("downloadURL")]
    except (ValueError, KeyError, TypeError) as e:
        raise RuntimeError("the metadata has no list of distributions") from e
    if not found:
        raise RuntimeError("the metadata has no download address")
    return found[0]


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, md5) of files, read as they are."""
    return spark.read.format("binaryFile").load(path).select("path", F.md5("content").alias("md5"))


def verified(sums: DataFrame, expected: DataFrame) -> DataFrame:
    """(path, ok): true, false, or NULL where nothing is expected."""
    return sums.join(expected.withColumnRenamed("md5", "wanted"), "path", "left").select("path", (F.lower("md5") == F.lower("wanted")).alias("ok"))


def cached(landed: DataFrame, as_of: str, ttl_hours: int) -> DataFrame:
    """Landed responses keyed by the SHA-256 of their address, the newest of each, not older than the time to live."""
    keyed = landed.withColumn("key", F.sha2("url", 256)).where(F.col("fetched_at") >= F.expr(f"timestamp '{as_of}' - interval {int(ttl_hours)} hours"))
    cols = [c for c in keyed.columns if c != "key"]
    return keyed.groupBy("key").agg(F.max_by(F.struct(*cols), "fetched_at").alias("r")).select("key", "r.*")


class VersionedTable:
    """A table as directories of versions; readers see the version that was published last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int | None:
        done = [int(n[1:]) for n in children(self.spark, self.path) if n.startswith("v") and n[1:].isdigit() and exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return max(done, default=None)

    def keep(self, versions: int) -> None:
        """Remove all but the last so many versions."""
        now = self.version()
        for n in children(self.spark, self.path):
            if now is not None and n.startswith("v") and n[1:].isdigit() and int(n[1:]) <= now - versions:
                remove(self.spark, f"{self.path}/{n}")

    def upsert(self, rows: DataFrame, keys: list[str]) -> int:
        """The next version: ``rows`` (one per key) in place of those with the same key."""
        if self.version() is None:
            return self.write(rows)
        return self.write(self.read().join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True))

    def read(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/v{self.version()}")

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write the next version. It counts once its _SUCCESS mark is there, so a failed write changes nothing."""
        n = -1 if self.version() is None else self.version()
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/v{n + 1}")
        return n + 1


def write_sheets(sheets: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Each sheet as a folder of its name; text with a header, or any format that Spark writes."""
    for name, df in sheets.items():
        flat = df.select(*[F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, (T.ArrayType, T.StructType)) else F.col(f"`{f.name}`") for f in df.schema.fields]) if fmt == "csv" else df
        writer = flat.write.mode("overwrite")
        text = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        (writer.options(**text) if fmt == "csv" else writer).format(fmt).save(str(Path(folder) / name) if "://" not in folder else f"{folder}/{name}")
