"""A corpus pipeline: language, exact duplicates, near duplicates, source mix, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as Parquet into the shared
folder and reads it again as the next stage's ``docs``. A stage works on all rows that its predecessor kept. All but
the last return the columns of ``docs``, in their order and whatever other columns there are.

Rows are addressed by id and a digest of the text, null-safe, so that repeated or null ids touch no other document.
Decisions meet the texts behind a bit table of fixed size: rows that no decision names are not shuffled.

A stage with Python tasks sets the session's limit of bytes for what goes to Python at once (``short_batches``), since its result is
computed when the caller writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echofield.llm import bpe, exact_dedup, language, lsh_forest, mixing
from echofield.llm.common import ARROW_LIMIT, bit_table, in_table, short_batches, staged

#: Lead under which a document's language is taken for unknown. Far below the operator's own flag: clean short texts stay.
REJECT_LEAD = 0.005
NEAR_THRESHOLD = 80
TOKENIZER = "word_bpe_49k.json"


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns named ``d0``, ``d1``, ... and the new name of each old one."""
    names = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(new).alias(old) for old, new in names.items()])


def _digest(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _decided(docs: DataFrame, id_col: str, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that no decision can name, and the others with the columns of theirs (null if there is none after all).

    ``docs`` has ``_h``; ``decisions`` has ``_id``, ``_h`` (one row for each pair) and its own columns.
    """
    table = staged(bit_table(decisions, ["_h"]), "decisions-table")
    marked = docs.withColumn("_table", table.scalar()).withColumn("_hit", in_table("_table", ["_h"])).drop("_table")
    hit = marked.filter("_hit").drop("_hit").withColumnRenamed("_h", "_h0")
    hit = hit.join(decisions, hit[id_col].eqNullSafe(decisions["_id"]) & (hit["_h0"] == decisions["_h"]), "left")
    return marked.filter("not _hit").drop("_hit", "_h"), hit.drop("_id", "_h")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Texts that are null or without a letter go, and those that no codeword is nearest to.

    The model learns from all rows with a text and a language. If there are none, only texts without a letter go.
    """
    short_batches(spark)
    d, names = _plain(docs)
    model = language.train(d, names["text"], names["lang"])
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    others = tuple(n for c, n in names.items() if c != "doc_id")
    told = language.predict(d, model, names["text"], names["doc_id"], others, REJECT_LEAD)
    return _named(told.filter((F.col("lang_pred") != language.UNDEFINED) & ~F.col("ambiguous")), names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space: most code points, then smallest id.

    Of rows that repeat that id in the group, the one with the most code points stays, then the largest text, then any.
    """
    d, names = _plain(docs)
    text, id_col = names["text"], names["doc_id"]
    d = d.withColumn("_h", F.unhex(F.sha2(exact_dedup.without_space(F.col(text)), 256)))
    found = exact_dedup.exact_dedup(d, text, id_col, keep=("_h",))
    found = found.groupBy(F.col(id_col).alias("_id"), "_h").agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
    decisions = staged(found.filter("not _kept or _rows > 1"), "copies")
    free, told = _decided(d, id_col, decisions)
    single = told.filter("_kept is null").drop("_kept", "_rows")
    again = told.filter("_kept").drop("_kept", "_rows").withColumn("_key", F.sha2(exact_dedup.without_space(F.col(text)), 256))
    whole = F.struct(*names.values())
    again = again.groupBy(id_col, "_key").agg(F.max_by(whole, F.struct(F.length(text), F.col(text))).alias("_row")).select("_row.*")
    return _named(free.unionByName(single.drop("_h0")).unionByName(again), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows that repeat this id in the group are one document."""
    short_batches(spark)
    d, names = _plain(docs)
    text, id_col = names["text"], names["doc_id"]
    d = d.withColumn("_h", _digest(text))
    found = lsh_forest.near_dedup(d, text, id_col, NEAR_THRESHOLD, keep=("_h",))
    decisions = staged(found.filter(~F.col("kept")).select(F.col(id_col).alias("_id"), "_h", F.lit(True).alias("_drop")).distinct(), "near-copies")
    free, told = _decided(d, id_col, decisions)
    return _named(free.unionByName(told.filter("_drop is null").drop("_drop", "_h0")), names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0, 1 or 2 times. Rows that repeat an id and a text are taken alike."""
    d, names = _plain(docs)
    text, id_col = names["text"], names["doc_id"]
    d = d.withColumn("_h", _digest(text))
    taken = mixing.mix(d, text, id_col, names["source"], keep=("_h",))
    taken = taken.groupBy(F.col(id_col).alias("_id"), "_h").agg(F.max("copies").cast("int").alias("_copies"))
    decisions = staged(taken.filter("_copies <> 1"), "mix-copies")
    free, told = _decided(d, id_col, decisions)
    told = told.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)))))
    return _named(free.unionByName(told.drop("_copies", "_copy", "_h0")), names)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``ids`` and the digest of the text that the ids decode to, for every row."""
    import public_tokenizers

    short_batches(spark)
    d, names = _plain(docs)
    coded = bpe.round_trip(d, public_tokenizers.path(TOKENIZER), names["text"], names["doc_id"], keep=(names["source"],))
    return coded.select(
        F.col(names["doc_id"]).alias("doc_id"), F.col(names["source"]).alias("source"), F.size("ids").cast("bigint").alias("n_tokens"),
        "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language), ("exact duplicates", drop_copies), ("near duplicates", drop_near_copies),
    ("source mix", mix_sources), ("tokens", encode_tokens),
]
#: Language, near duplicates and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.conf.get(ARROW_LIMIT)
    try:
        for name, stage in STAGES:
            docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        spark.conf.set(ARROW_LIMIT, before)
    return docs
