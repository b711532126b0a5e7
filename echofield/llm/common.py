"""Staged tables, joins that stay even when a key is hot, and batches of bounded size inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofield.sources.tables import shared_folder

#: A key counts as hot from this share of the rows on, so there are never more hot keys than its inverse.
HOT_SHARE = 1000
#: White space of the text contracts, as a class of Java, Python and RE2 patterns.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns at once.
BATCH_BYTES = 8 << 20
#: log2 of the bits of a table of hashed keys that goes with a scan: 512 KB.
TABLE_BITS = 22


#: Bytes of rows that Spark gathers before it sends them to a Python worker. Spark's own limit counts rows, 10,000 of them.
ARROW_BYTES = 4 << 20
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Frees the shuffle files of a query once it has run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def short_batches(spark) -> None:
    """From now on this session sends rows to Python in batches of ``ARROW_BYTES``, so that long texts take no more memory than short ones."""
    spark.conf.set(ARROW_LIMIT, str(ARROW_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of the session and read it back.

    Cuts the lineage: an executor that is lost later costs no more than its own tasks. The shuffle files behind the table
    are freed with its write; the table itself stays until ``release``.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(folder)
    out._staged_folder = folder
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; others are left alone."""
    for t in tables:
        folder = getattr(t, "_staged_folder", None)
        if folder is not None:
            jvm = t.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group; rows without a group get nulls.

    ``groups`` has one row for each ``key`` and the number of its rows in ``size``; ``total`` is the number of
    rows. Groups over ``total / HOT_SHARE`` rows are at most ``HOT_SHARE`` and are broadcast; the others are joined
    by a shuffle in which no key has more rows than that. A null key joins nothing.
    """
    is_hot = F.col(size) * HOT_SHARE > F.lit(total)
    values = [c for c in groups.columns if c != key]
    hot = groups.filter(is_hot).withColumn("_hot", F.lit(True))
    marked = rows.filter(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left")
    first = marked.filter(F.col("_hot")).drop("_hot")
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot", *values)
    rest = rest.join(groups.filter(~is_hot), key, "left")
    types = dict(groups.dtypes)
    none = rows.filter(F.col(key).isNull()).withColumns({c: F.lit(None).cast(types[c]) for c in values})
    return first.unionByName(rest).unionByName(none)


def _slot(keys: list[str] | list[Column], bits: int, hashed: bool) -> Column:
    if hashed:
        key = keys[0] if isinstance(keys[0], Column) else F.col(keys[0])
        return key.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    return F.pmod(F.xxhash64(*keys), F.lit(1 << bits))


def bit_table(rows: DataFrame, keys: list[str], bits: int = TABLE_BITS, hashed: bool = False) -> DataFrame:
    """One row with ``_table``, an array of 2^(bits - 6) longs whatever the number of rows: a bit for each hashed key.

    With ``hashed`` the one key is a 64-bit hash already and is not hashed again.
    """
    words = 1 << (bits - 6)
    slot = _slot(keys, bits, hashed)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    table = rows.select(F.shiftright(slot, 6).alias("_word"), one.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    every = rows.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    table = table.unionByName(every).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    ordered = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    return table.agg(F.transform(ordered, lambda x: x["_bits"]).alias("_table"))


def in_table(table: str | Column, keys: list[str] | list[Column], bits: int = TABLE_BITS, hashed: bool = False) -> Column:
    """False only for keys that are not in the table; true for all that are and for few others while it is not full."""
    slot = _slot(keys, bits, hashed)
    word = F.element_at(table, (F.shiftright(slot, 6) + 1).cast("int"))
    # a shift of a long takes the last six bits of its count
    return F.call_function("shiftright", word, slot.cast("int")).bitwiseAND(F.lit(1)) == 1


def identity(name: str = "doc_id") -> Column:
    """The id as text, as the fold rules take it."""
    return F.col(name).cast("string")


def fold(divisor: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(identity(key), F.lit("")).cast("binary")) % divisor


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``most`` bytes of ``column`` (a longer text is alone)."""
    at = None
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
