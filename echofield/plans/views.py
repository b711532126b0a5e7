"""Review-shaped views over the driver tables, each with its SQL twin.

``scored`` supplies the columns that later stages add (cluster, anomaly, severity, route, churn) by plain
rules over the event attributes, so that operators which only *read* those columns can be checked exactly.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import calendar as cal
from echofield.functions import labels as lb
from echofield.functions import text as tx
from echofield.sources.tables import spread

# Words that do occur in the driver documents, standing in for the legal and money lists.
LEGAL_HERE = ["stupid", "moron", "scum"]
MONEY_HERE = ["trash", "clown", "from"]
PAIR_HERE = ("trash", "clown")


# Expressions over these are CPU-bound, so they should use every core even when the file is one split.
TEXT_TABLES = {"documents", "pages", "conversations"}


class Tables:
    """The tables of one data folder plus the derived views. Every view is a lazy plan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(df) if name in TEXT_TABLES else df

    def _joined(self, **extra) -> DataFrame:
        """Reviews with all that is read from their text alone, worked out before the join: a view that keeps only flags and
        lengths shuffles no texts. ``extra`` are further functions of the cleaned text."""
        e = self("events").select(
            "event_id", "ts", "event_type", "value", "user_id",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )
        d = self("documents").withColumn("cleaned_content", tx.clean_text(F.col("text")))
        low = F.lower("text")
        d = d.select(
            "*", tx.word_count(F.col("cleaned_content")).alias("review_length"), tx.any_word(F.col("text"), LEGAL_HERE).alias("_legal"),
            F.coalesce(F.contains(low, F.lit(PAIR_HERE[0])) & F.contains(low, F.lit(PAIR_HERE[1])), F.lit(False)).alias("_pair"),
            *[f(F.col("cleaned_content")).alias(name) for name, f in extra.items()],
        )
        return d.join(e, d.doc_id == e.event_id).select(
            F.col("doc_id").alias("id"),
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("review_id"),
            F.col("source").alias("platform"),
            "lang",
            F.col("text").alias("content"),
            F.when(F.col("k") % 17 == 0, None).otherwise((1 + F.col("k") % 5).cast("double")).alias("score"),
            F.col("k").alias("thumbs_up"),
            F.col("ts").alias("at"),
            F.col("event_type").alias("topic"),
            "value",
            "user_id",
            "cleaned_content", "review_length", "_legal", "_pair", *extra,
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self._joined().drop("cleaned_content", "review_length", "_legal", "_pair")

    def _cleaned(self, **extra) -> DataFrame:
        c = self._joined(**extra)
        last = ["review_length", "_legal", "_pair", *extra]
        return c.select(
            *[x for x in c.columns if x not in last],
            "review_length",
            lb.star_bucket(F.col("score")).alias("star_bucket"),
            lb.high_engagement(F.col("thumbs_up")).alias("high_engagement"),
            cal.week_label(F.col("at")).alias("week"),
            cal.month_label(F.col("at")).alias("year_month"),
            *last[1:],
        )

    @cached_property
    def cleaned(self) -> DataFrame:
        """Reviews plus the text and calendar features."""
        return self._cleaned().drop("_legal", "_pair")

    @cached_property
    def vectors(self) -> DataFrame:
        """id, vec_id, embedding, label: one vector per review by id modulo the number of vectors."""
        emb = self("embeddings")
        n = emb.agg(F.count(F.lit(1))).scalar()
        ids = self("documents").select(F.col("doc_id").alias("id")).withColumn("n_vec", n)
        return ids.withColumn("vec_id", F.col("id") % F.col("n_vec")).drop("n_vec").join(emb, "vec_id").select(
            "id", "vec_id", "embedding", "label"
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Cleaned reviews plus stand-ins for the columns of the later stages."""
        return self.scored_with()

    def scored_with(self, **extra) -> DataFrame:
        """``scored`` with further functions of the cleaned text, worked out beside it."""
        k, v = F.col("thumbs_up"), F.col("value")
        c = self._cleaned(**extra).join(self.vectors.select("id", F.col("label").alias("kmeans_cluster")), "id")
        names = F.create_map(*[F.lit(x) for kv in fixed.CLUSTER_NAMES.items() for x in kv])
        c = c.select(
            "*",
            F.coalesce(
                names[F.col("kmeans_cluster")],
                F.concat(F.lit("Cluster "), F.col("kmeans_cluster").cast("string")),
            ).alias("cluster_name"),
            F.when(k % 7 == 3, -1).otherwise(F.col("kmeans_cluster") % 4).alias("hdbscan_cluster"),
            (k % 7 == 3).alias("hdbscan_is_noise"),
            (v > 120).alias("isolation_anomaly"),
            (v / 100).alias("isolation_score"),
            F.when(k % 11 == 0, None).otherwise(F.col("topic")).alias("route_category"),
            ((k % 50) / 50.0).alias("route_confidence"),
            (F.col("user_id") % 100 / 100.0).alias("severity_score_ml"),
            ((k * 7 + F.col("user_id")) % 100 / 100.0).alias("churn_risk_score"),
            tx.short_id(F.col("id")).alias("sid"),
        )
        c = c.select(
            "*",
            (F.col("isolation_anomaly") & F.col("hdbscan_is_noise")).alias("tier1_critical"),
            lb.severity_colour(F.col("isolation_anomaly"), F.col("hdbscan_is_noise")).alias("severity"),
            lb.churn_band(F.col("churn_risk_score")).alias("churn_risk_label"),
            lb.severity_label(F.col("_legal"), F.col("score")).alias("severity_label_weak"),
            lb.severity_label(F.col("_legal") | F.col("_pair"), F.col("score")).alias("severity_label_gold"),
        )
        return c.select(*[x for x in c.columns if x not in ("_legal", "_pair", *extra)], *extra)

    @cached_property
    def queries(self) -> DataFrame:
        """Search questions: query_id and question from the benchmark passages."""
        return self("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


# --- SQL twins ---------------------------------------------------------------------------------

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

REVIEWS = """reviews AS (
  SELECT d.doc_id AS id, 'doc-' || d.doc_id AS review_id, d.source AS platform, d.lang, d.text AS content,
         CASE WHEN e.k % 17 = 0 THEN NULL ELSE CAST(1 + e.k % 5 AS DOUBLE) END AS score,
         e.k AS thumbs_up, e.ts AS "at", e.event_type AS topic, e.value, e.user_id
  FROM documents d JOIN (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
    ON e.event_id = d.doc_id)"""


# RE2 has no back-references, so the SQL twin shortens runs one character at a time.
_RUN_CHARS = list("abcdefghijklmnopqrstuvwxyz0123456789_.,!?-éóèñçüêäöíßàâîïôùûáúœæ") + ["''"]


def _run(ch: str) -> str:
    return ("\\" + ch if ch in ".?" else ch) + "{4,}"


def squeeze_sql(s: str) -> str:
    for ch in _RUN_CHARS:
        s = f"regexp_replace({s}, '{_run(ch)}', '{ch}{ch}', 'g')"
    return s


def plain_sql(c: str) -> str:
    """SQL form of the cleaning rule before runs are shortened."""
    ws = WS[1:-1]
    s = f"lower(coalesce({c}, ''))"
    s = rf"regexp_replace({s}, 'http[^{ws}]+|www[^{ws}]+', ' ', 'g')"
    s = rf"regexp_replace({s}, '<[^>]+>', ' ', 'g')"
    s = rf"regexp_replace({s}, '[^\p{{L}}\p{{N}}_{ws}\x{{0900}}-\x{{097F}}.,!?''-]', ' ', 'g')"
    return s


def tidy_sql(s: str) -> str:
    return f"trim(regexp_replace({s}, '{WS}+', ' ', 'g'))"


def clean_sql(c: str) -> str:
    """SQL form of the whole cleaning rule."""
    return tidy_sql(squeeze_sql(plain_sql(c)))


_ANY_RUN = "|".join(map(_run, _RUN_CHARS))
CLEANED = REVIEWS + """,
plain0 AS (SELECT *, """ + plain_sql("content") + """ AS _p FROM reviews),
cleaned0 AS (SELECT * EXCLUDE (_p), """ + tidy_sql(f"CASE WHEN regexp_matches(_p, '{_ANY_RUN}') THEN {squeeze_sql('_p')} ELSE _p END") + """ AS cleaned_content FROM plain0),
cleaned AS (
  SELECT *,
    CAST(CASE WHEN cleaned_content = '' THEN 0 ELSE len(string_split(cleaned_content, ' ')) END AS INTEGER)
      AS review_length,
    CASE WHEN score IS NULL THEN 'unknown' WHEN score <= 2 THEN 'complaint' WHEN score = 3 THEN 'mixed'
         ELSE 'positive' END AS star_bucket,
    thumbs_up > 10 AS high_engagement,
    strftime(date_trunc('week', "at"), '%Y-%m-%d') || '/' ||
      strftime(date_trunc('week', "at") + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
    strftime("at", '%Y-%m') AS year_month
  FROM cleaned0)"""

VECTORS = """vectors AS (
  SELECT d.doc_id AS id, v.vec_id, v.embedding, v.label
  FROM documents d JOIN embeddings v ON v.vec_id = d.doc_id % (SELECT count(*) FROM embeddings))"""


def word_pattern(terms) -> str:
    return r"(?i)\b(" + "|".join(terms) + r")\b"


_NAMES = " ".join(f"WHEN {i} THEN '{n}'" for i, n in fixed.CLUSTER_NAMES.items())

SCORED = CLEANED + ",\n" + VECTORS + f""",
scored0 AS (
  SELECT c.*, v.label AS kmeans_cluster,
    CASE v.label {_NAMES} ELSE 'Cluster ' || v.label END AS cluster_name,
    CASE WHEN thumbs_up % 7 = 3 THEN -1 ELSE v.label % 4 END AS hdbscan_cluster,
    thumbs_up % 7 = 3 AS hdbscan_is_noise,
    value > 120 AS isolation_anomaly,
    value / 100 AS isolation_score,
    CASE WHEN thumbs_up % 11 = 0 THEN NULL ELSE topic END AS route_category,
    (thumbs_up % 50) / 50.0::DOUBLE AS route_confidence,
    (user_id % 100) / 100.0::DOUBLE AS severity_score_ml,
    ((thumbs_up * 7 + user_id) % 100) / 100.0::DOUBLE AS churn_risk_score,
    'R' || lpad(CAST(id AS VARCHAR), CAST(greatest(4, length(CAST(id AS VARCHAR))) AS INTEGER), '0') AS sid
  FROM cleaned c JOIN vectors v USING (id)),
scored AS (
  SELECT *,
    isolation_anomaly AND hdbscan_is_noise AS tier1_critical,
    CASE WHEN isolation_anomaly AND hdbscan_is_noise THEN 'RED' WHEN isolation_anomaly THEN 'AMBER'
         ELSE 'GREEN' END AS severity,
    CASE WHEN churn_risk_score >= 0.7 THEN 'High' WHEN churn_risk_score >= 0.4 THEN 'Medium' ELSE 'Low' END
      AS churn_risk_label,
    CASE WHEN regexp_matches(content, '{word_pattern(LEGAL_HERE)}') THEN 2 WHEN score <= 2 THEN 1 ELSE 0 END
      AS severity_label_weak,
    CASE WHEN regexp_matches(content, '{word_pattern(LEGAL_HERE)}')
           OR (contains(lower(content), '{PAIR_HERE[0]}') AND contains(lower(content), '{PAIR_HERE[1]}')) THEN 2
         WHEN score <= 2 THEN 1 ELSE 0 END AS severity_label_gold
  FROM scored0)"""

QUERIES_SQL = "queries AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
