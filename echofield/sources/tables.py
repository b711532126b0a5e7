"""Reading and writing stage tables. Parquet between stages; CSV and JSON at the edges."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTE_ORDER_MARK = "\ufeff"
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("thumbs_up", T.IntegerType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("app_version", T.StringType()),
    ]
)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared location of ``spark.checkpoint.dir`` (temporary only on a local master)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        import tempfile

        root = tempfile.mkdtemp(prefix="echofield-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, read as often as needed."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a scan has fewer splits than cores (one small file); otherwise unchanged.

    Filters and column pruning still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns by name, bad values -> null, absent columns -> null."""
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV by header name; a byte-order mark on the first name is ignored; quoted line breaks are kept."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    first = raw.columns[0].lstrip(BYTE_ORDER_MARK).strip('"')
    return typed(raw.toDF(first, *raw.columns[1:]), schema)


def write_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """CSV with a header; ``mark`` puts a byte-order mark before it, as spreadsheets want it."""
    if mark and df.columns:
        df = df.toDF(BYTE_ORDER_MARK + df.columns[0], *df.columns[1:])
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = True) -> DataFrame:
    r = spark.read.schema(schema) if schema else spark.read
    return r.json(path, multiLine=multiline)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The richest available stage table: the first listed path that exists."""
    for p in paths:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {paths} exists")


def ingest(raw: DataFrame, newest: int = 500, at: str = "at", key: str = "review_id") -> DataFrame:
    """Default the fields and keep the newest rows of every (platform, language) cell.

    ``row_number() <= n`` is cut per task before the shuffle.
    """
    d = raw.select(
        key, "platform", F.lit("store").alias("source"), "lang",
        F.trim(F.coalesce("content", F.lit(""))).alias("content"),
        "score", F.coalesce("thumbs_up", F.lit(0)).alias("thumbs_up"), at,
    )
    w = W.partitionBy("platform", "lang").orderBy(F.desc(at), F.asc(key))
    return d.withColumn("newest_rank", F.row_number().over(w)).filter(F.col("newest_rank") <= newest)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-free content signature: rows, sum and xor of per-row hashes. One pass, partial sums.

    Names and values go in with their lengths, so no two different rows read the same.
    """

    def part(c: str):
        v = F.col(f"`{c}`").cast("string")
        return F.concat(F.lit(f"{len(c)}:{c}="), F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")))

    text = F.concat_ws("|", *[part(c) for c in columns or df.columns])
    h = F.md5(text)
    number = lambda a, n: F.conv(F.substring(h, a, n), 16, 10).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(number(1, 8)).alias("hash_sum"),
        F.bit_xor(number(9, 15)).alias("hash_xor"),
    )


def write_if_changed(df: DataFrame, path: str, columns: list[str] | None = None) -> bool:
    """Write the table and its signature unless the stored signature already equals the new one."""
    spark = df.sparkSession
    new = fingerprint(df, columns)
    mark = path.rstrip("/") + ".signature"
    if path_exists(spark, mark) and new.exceptAll(spark.read.parquet(mark)).isEmpty():
        return False
    write_parquet(df, path)
    write_parquet(new, mark)
    return True


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of keys on one side only and on both."""
    l, r = left.select(key).withColumn("_l", F.lit(1)), right.select(key).withColumn("_r", F.lit(1))
    j = l.join(r, key, "full_outer")
    return j.agg(
        F.count_if(F.col("_r").isNull()).alias("left_only"), F.count_if(F.col("_l").isNull()).alias("right_only"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("matched"),
    )


def require_aligned(left: DataFrame, right: DataFrame, key: str) -> None:
    row = alignment(left, right, key).first()
    if row.left_only or row.right_only:
        raise ValueError(f"{row.left_only} keys lack a vector and {row.right_only} vectors lack a row; rebuild the vectors")


def corpus(df: DataFrame) -> DataFrame:
    """Search corpus: the metadata fields and the text."""
    date = F.substring(F.col("at").cast("string"), 1, 10)
    return df.select(
        "sid", "review_id", "platform", F.col("score").alias("rating"), date.alias("date"), "kmeans_cluster",
        "cluster_name", "hdbscan_cluster", "severity", F.col("severity_label_ml").alias("severity_ml"),
        F.coalesce("isolation_anomaly", F.lit(False)).alias("is_anomaly"),
        F.col("route_category").alias("routing_team"), "lang", "content",
    )


def id_map(df: DataFrame) -> DataFrame:
    return df.select("sid", "review_id")


def latest_models(log: DataFrame) -> DataFrame:
    """Newest entry per task of an append-only registry (partial max per task; no window); other columns come along."""
    rest = F.struct(*[c for c in log.columns if c != "task"])
    return log.groupBy("task").agg(F.max_by(rest, F.struct("run_ts", "model")).alias("m")).select("task", "m.*")


def upsert_models(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the tasks in ``new``, keep the others."""
    return registry.join(new.select("task").distinct(), "task", "left_anti").unionByName(new)


def changed_keys(current: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose (keys, signature) is not in the cache: the only ones to recompute."""
    return current.join(cached.select(*keys, "signature"), [*keys, "signature"], "left_anti")


def merge_cache(cached: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    return cached.join(recomputed.select(*keys), keys, "left_anti").unionByName(recomputed, allowMissingColumns=True)


def literal_table(spark: SparkSession, mapping: dict, names: list[str]) -> DataFrame:
    """A small lookup table from a constant mapping."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], names)


def lookup(df: DataFrame, column: str, mapping: dict, name: str, default: Column) -> DataFrame:
    """Constant map lookup with a default: no join at all."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(name, F.coalesce(m[F.col(column)], default))
