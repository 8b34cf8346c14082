"""History of changing attributes, kept as chains of periods.

Method: affected-chain rebuild. Raw changes are kept; when late or corrected
updates arrive, only the raw changes of the entities they touch are read, all
intervals of those entities are rebuilt, and their chains are replaced in one
step. Chains of other entities are not recomputed.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.session import written
from rosterlake.sources.files import children


def folded(col: Column) -> Column:
    """The form in which two values are equal if they differ in case or spaces only."""
    return F.trim(F.regexp_replace(F.lower(col), r"(?U)\s+", " "))


def raw_changes(rows: DataFrame, key: str, at: str, attrs: list[str]) -> DataFrame:
    """One row per (key, at): the folded value of each attribute, or null.

    Repeated deliveries of one state collapse before the shuffle (``max`` is
    combined map-side). Of several values for one key and moment the greatest
    is taken, so that the result doesn't depend on the order of arrival. Rows
    without key or moment can't be placed and are left out.
    """
    read = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    return read.groupBy(key, at).agg(*[F.max(folded(F.col(a))).alias(a) for a in attrs])


def build_chains(raw: DataFrame, key: str, at: str, attrs: list[str]) -> DataFrame:
    """(key, attrs, valid_from, valid_to) from raw changes; the last period has a null valid_to.

    A null says nothing: the value before it holds on. A version begins where
    an attribute differs from the version before and ends where the next
    begins. Moments at which no attribute has had any value yet begin no
    version. A chain is as long as one entity's changes; entities are spread
    by the hash of their key, so no group grows with the table.
    """
    by_key = Window.partitionBy(key).orderBy(at)
    held = raw.select(key, at, *[F.last(a, ignorenulls=True).over(by_key).alias(a) for a in attrs])
    held = held.where(reduce(Column.__or__, [F.col(a).isNotNull() for a in attrs]))
    state = F.struct(*attrs)
    starts = held.withColumn("__before", F.lag(state).over(by_key)).where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state))
    return starts.select(key, *attrs, F.col(at).alias("valid_from"), F.lead(at).over(by_key).alias("valid_to"))


def said_new(raw_before: DataFrame, update: DataFrame, key: str, at: str, attrs: list[str]) -> DataFrame:
    """The raw changes of ``update`` with a moment or value that ``raw_before`` doesn't have."""
    same = [F.col(f"u.{c}") == F.col(f"r.{c}") for c in (key, at)]
    return update.alias("u").join(raw_before.alias("r"), same, "left").where(
        F.col(f"r.{key}").isNull() | reduce(Column.__or__, [F.col(f"u.{a}").isNotNull() & ~F.col(f"u.{a}").eqNullSafe(F.col(f"r.{a}")) for a in attrs])
    ).select("u.*")


def rebuild_affected(chains: DataFrame, raw_before: DataFrame, update: DataFrame, key: str, at: str, attrs: list[str]) -> DataFrame:
    """Chains after ``update`` (more raw changes of the form of ``raw_changes``).

    Touched are the keys for which the update has a moment or value that the
    raw changes don't have (``said_new``). Only their raw changes are
    retrieved and rebuilt; the others' chains pass through. An update that
    says nothing new returns ``chains``.
    """
    return replaced(chains, raw_before, said_new(raw_before, update, key, at, attrs), key, at, attrs)


def replaced(chains: DataFrame, raw_before: DataFrame, new: DataFrame, key: str, at: str, attrs: list[str]) -> DataFrame:
    """Chains with those of the keys in ``new`` rebuilt from their raw changes and ``new``."""
    touched = new.select(key).distinct()
    theirs = raw_before.join(touched, key, "left_semi").unionByName(new)
    merged = theirs.groupBy(key, at).agg(*[F.max(a).alias(a) for a in attrs])
    return chains.join(touched, key, "left_anti").unionByName(build_chains(merged, key, at, attrs))


#: Buckets of a store's keys; a bucket is what an update rewrites at least.
BUCKETS = 64


class ChainStore:
    """Raw changes and chains as tables in a folder, bucketed by key; updates replace the touched chains atomically.

    An update writes only the buckets that hold touched keys, and reads only
    these. A manifest names the version in force of every bucket and is
    replaced by a rename after all of an update's files are complete: a reader
    sees the old chains or the new ones, never a mixture, and a failed update
    leaves the old ones in force. Files that neither this manifest nor the one
    before names are removed. One writer at a time.
    """

    def __init__(self, path: str, key: str, at: str, attrs: list[str], buckets: int = BUCKETS):
        self.path, self.key, self.at, self.attrs, self.buckets = path.rstrip("/"), key, at, attrs, buckets

    def _fs(self, spark):
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(spark._jsc.hadoopConfiguration())

    def manifest(self, spark) -> dict:
        """{"version": n, "buckets": {bucket: version}}; without a store version -1 and no buckets."""
        jvm, fs = self._fs(spark)
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT")):
            return {"version": -1, "buckets": {}}
        return json.loads(spark.read.text(f"{self.path}/CURRENT", wholetext=True).first()[0])

    def _publish(self, spark, manifest: dict) -> None:
        jvm, fs = self._fs(spark)
        made = jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT.{manifest['version']}")
        out = fs.create(made, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        pointer = jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), spark._jsc.hadoopConfiguration()) if made.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
        overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(made, pointer, overwrite)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, spark, what: str, manifest: dict, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/{what}/v{v}/bucket={b}" for b, v in manifest["buckets"].items() if only is None or int(b) in only]
        jvm, fs = self._fs(spark)
        # A bucket whose keys have no version yet has raw changes only.
        there = [p for p in paths if what == "raw" or fs.exists(jvm.org.apache.hadoop.fs.Path(p))]
        return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)

    def _schema(self, rows: DataFrame, chains: bool) -> T.StructType:
        key, at = rows.schema[self.key], rows.schema[self.at].dataType
        attrs = [T.StructField(a, T.StringType()) for a in self.attrs]
        return T.StructType([key, *attrs, T.StructField("valid_from", at), T.StructField("valid_to", at)] if chains else [key, T.StructField(self.at, at), *attrs])

    def chains(self, spark, schema: T.StructType | None = None) -> DataFrame:
        """All chains in force."""
        manifest = self.manifest(spark)
        return self._read(spark, "chains", manifest, schema or T.StructType.fromJson(manifest["schema"]))

    def apply(self, rows: DataFrame) -> int:
        """Add rows, rebuild the touched chains, return the new version.

        A key is touched if the rows say something of it that the store
        doesn't know. Buckets without a touched key stay as they are.
        """
        spark, now = rows.sparkSession, self.manifest(rows.sparkSession)
        version, names = now["version"] + 1, [self.key, self.at, *self.attrs]
        update = raw_changes(rows, self.key, self.at, self.attrs).select(*names)
        raw = self._read(spark, "raw", now, self._schema(update, False))
        new = written(said_new(raw, update, self.key, self.at, self.attrs))
        # As many as there are buckets.
        touched = {r[0] for r in new.select(self._bucket().alias("b")).distinct().collect()}
        if touched:
            before = [self._read(spark, what, now, self._schema(update, what == "chains"), touched) for what in ("raw", "chains")]
            merged = before[0].unionByName(new).groupBy(self.key, self.at).agg(*[F.max(a).alias(a) for a in self.attrs])
            rebuilt = replaced(before[1], before[0], new, self.key, self.at, self.attrs)
            for what, df in (("raw", merged), ("chains", rebuilt)):
                df.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{what}/v{version}")
        after = {"version": version, "buckets": now["buckets"] | {str(b): version for b in touched}, "schema": self._schema(update, True).jsonValue()}
        self._publish(spark, after)
        self._tidy(spark, now, after)
        return version

    def _tidy(self, spark, *kept: dict) -> None:
        """Remove files that none of the manifests names."""
        jvm, fs = self._fs(spark)
        named = {(str(v), str(b)) for m in kept for b, v in m["buckets"].items()}
        for what in ("raw", "chains"):
            for v in children(spark, f"{self.path}/{what}"):
                for b in children(spark, f"{self.path}/{what}/{v}"):
                    if b.startswith("bucket=") and (v[1:], b[7:]) not in named:
                        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{what}/{v}/{b}"), True)
