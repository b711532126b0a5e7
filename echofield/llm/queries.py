"""The registered queries of the subpackage and, where SQL can say it, their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echofield.llm import bpe, bwt, collocations, contamination, cotraining, exact_dedup, language, lsh_forest, maxent, mixing, periodic, token_cache, topk
from echofield.llm.common import fold, staged

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents of two folds of three."""
    d = table(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", fold(3) == 1)
    return language.identify(d, ~F.col("held_out"), keep=("held_out",)).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its text and its page, learned by co-training."""
    d = table(spark, sf_dir)
    return cotraining.score(d, cotraining.train(d, table(spark, sf_dir, "labels")))


NEAR_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
), s as (
  select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end as sh from w
), e as (
  select doc_id, unnest(sh) as g from s
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by all
), l as (
  select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * n >= 85 * (len(x.sh) + len(y.sh) - n)
), u as (
  select a, b from l union all select b, a from l
), r(a, b) as (
  select a, b from u union select r.a, u.b from r join u on r.b = u.a
), m as (
  select a, min(b) as low from r group by a
)
select doc_id, len(sh)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id,
  doc_id <= coalesce(low, doc_id) as kept from s left join m on s.doc_id = m.a
"""


@query("op3_near_dedup", NEAR_SQL)
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates over all documents."""
    return lsh_forest.near_dedup(table(spark, sf_dir))


@query("op4_repeated_passages")
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that 200-byte strings found elsewhere cover, and the digest of what is left."""
    found = bwt.repeated_passages(table(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("rest", 256).alias("kept_sha256"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a digest cache that starts empty."""
    counts = token_cache.token_counts(table(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op10_bpe_round_trip")
def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    coded = bpe.round_trip(table(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    ids = F.concat_ws(" ", F.transform("ids", lambda i: i.cast("string")))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from six folds of seven."""
    d = table(spark, sf_dir).select("doc_id", "text").withColumn("held_out", fold(7) == 2)
    model, counts = maxent.train(d.filter(~F.col("held_out")), key=F.col("doc_id"))
    scores = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return maxent.score(d, model, counts, keep=("held_out",)).select("doc_id", "held_out", *scores)


MIX_SQL = r"""
with d as (
  select doc_id, source, coalesce(text, '') as t,
    (('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '')), 1, 13))::bigint + 0.5) / 4503599627370496.0::double as u
  from documents
), s as (
  select doc_id, source, u, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::bigint as size,
    case when length(t) = 0 then 1.0::double
      else length(t)::double / (length(t) + 10 * len(regexp_extract_all(t, '[!-@\[-`{-~]'))) end as w
  from d
), p as (
  select source, sum(size)::bigint as source_size,
    ([5.0, 2.0, 1.0]::double[])[1 + (row_number() over (order by source is null, source) - 1) % 3] as weight
  from s group by source
), q as (
  select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as ratio,
    row_number() over (order by source is null, source) as pos from p
), l as (
  select *, (sum(source_size) over () * 1.5::double - (sum(cap) over (order by ratio, pos) - cap))
    / (sum(weight) over () - sum(weight) over (order by ratio, pos) + weight) as level from q
), g as (
  select source, source_size,
    least(cap, weight * (select arg_min(level, {'r': ratio, 'p': pos}) from l where level <= ratio)) as target from q
), m as (
  select s.doc_id, s.size, g.source_size, g.target,
    case when g.source_size = 0 then 0 else floor(g.target / g.source_size) end::bigint as epochs,
    sum(s.size) over (partition by s.source order by -ln(s.u) / greatest(s.w, 1e-6), s.doc_id
      rows between unbounded preceding and current row) as upto
  from s join g on s.source is not distinct from g.source
), c as (
  select *, epochs + case when target - epochs * source_size > 0 and epochs < 2
    and upto - size / 2.0::double <= target - epochs * source_size then 1 else 0 end as copies from m
)
select doc_id, size, source_size, target, copies::bigint as copies, (size * copies)::bigint as taken from c
"""


@query("op6_mix_sources", MIX_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the source weights."""
    return mixing.mix(table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


EXACT_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as h from documents
), w as (
  select doc_id, h, first_value(doc_id) over (partition by h order by length(t) desc, doc_id) as keep_id,
    count(*) over (partition by h) as group_size from d
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from w
"""


@query("op8_exact_dedup", EXACT_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    d = table(spark, sf_dir)
    digest = F.sha2(exact_dedup.without_space(F.col("text")), 256)
    return exact_dedup.exact_dedup(d.select("doc_id", "text", digest.alias("text_sha256")), keep=("text_sha256",))


TOPK_SQL = r"""
with t as (
  select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as ws from documents
), n as (
  select count(*)::double as n, sum(len(ws)) / count(*)::double as mean from t
), p as (
  select doc_id, len(ws) as dl, unnest(ws) as w from t
), f as (
  select doc_id, dl, w, count(*) as tf from p group by all
), q as (
  select item_id, w, count(*) as times
  from (select item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) as w from benchmark where item_id % 20 = 0) group by all
), i as (
  select w, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) as idf from f, n where w in (select w from q) group by w
), s as (
  select item_id, doc_id, round(sum(times * idf * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * (dl / mean)))), 6) as score
  from f join q using (w) join i using (w), n group by item_id, doc_id
), r as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s
)
select item_id, rank::int as rank, doc_id, score from r where rank <= 10
"""


@query("op9_topk_search", TOPK_SQL)
def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item whose id is divisible by 20, against all documents."""
    index = staged(topk.build_index(table(spark, sf_dir)), "search-index")
    asked = table(spark, sf_dir, "benchmark").filter("item_id % 20 = 0")
    found = topk.search(index, asked, 10, "text", "item_id")
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


#: Different terms of a document from which on its search takes whole postings.
DOCUMENT_TERMS = 8


@query("document_search_op9")
def document_search_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20, against all documents."""
    d = table(spark, sf_dir)
    index = staged(topk.build_index(d), "search-index")
    found = topk.search(index, d.filter("doc_id % 20 = 0"), 10, "text", "doc_id", DOCUMENT_TERMS)
    return found.select("query_id", "rank", F.col("id").alias("doc_id"), "score")


LEAK_SQL = r"""
with i as (
  select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark
), d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), w as (
  select distinct item, width, array_to_string(ws[j:j + width - 1], ' ') as g
  from (select *, least(len(ws), 10) as width from i where len(ws) > 0), unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as u(j)
), x as (
  select doc_id, j, width, array_to_string(ws[j:j + width - 1], ' ') as g
  from d, (select distinct width from w), unnest(range(1, greatest(len(ws) - width + 2, 1))) as u(j)
), m as (
  select x.doc_id, x.j, x.width, w.item from x join w on x.width = w.width and x.g = w.g
), h as (
  select doc_id, count(distinct p) as n_hit from (select distinct doc_id, j, width from m), unnest(range(j, j + width)) as u(p) group by doc_id
), t as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from m) group by doc_id
)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""


@query("op11_decontamination", LEAK_SQL)
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover, and the items that they come from."""
    found = contamination.contaminated(table(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


PHRASE_SQL = r"""
with d as (
  select doc_id, coalesce(lang, 'und') as lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps
  from documents
), p as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from (select lang, unnest(ps) as piece from d)
), g as (
  select lang, k, array_to_string(ws[j:j + k - 1], ' ') as phrase, ws[j:j + k - 1] as w
  from p, (values (1), (2), (3)) as v(k), unnest(range(1, greatest(len(ws) - k + 2, 1))) as u(j)
), f as (
  select lang, k, phrase, any_value(w) as w, count(*) as a from g group by lang, k, phrase
), n as (
  select lang, sum(a)::bigint as n from f where k = 1 group by lang
), c as (
  select lang, k, phrase, w, a from f where k > 1 and a >= 10
), cuts as (
  select c.lang, c.phrase, c.a, j, l.a as l, r.a as r, (1000000::hugeint * c.a * c.a) // (l.a::hugeint * r.a) as score
  from c, unnest(range(1, c.k)) as u(j)
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:j], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[j + 1:c.k], ' ')
), best as (
  select lang, phrase, any_value(a) as a, min({'s': score, 'j': j, 'l': l, 'r': r}) as b from cuts group by lang, phrase
), part as (
  select x.lang, x.phrase from c x join (
    select lang, array_to_string(w[1:2], ' ') as phrase, a from c where k = 3 union all select lang, array_to_string(w[2:3], ' '), a from c where k = 3
  ) y on x.lang = y.lang and x.phrase = y.phrase where 100 * y.a >= 50 * x.a
), r as (
  select b.lang, row_number() over (partition by b.lang order by b.b.s desc, b.a desc, encode(b.phrase)) as rank, b.phrase, b.a, b.b.l as l, b.b.r as r, b.b.s as score
  from best b anti join part using (lang, phrase)
)
select r.lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r.r::bigint as r, n.n, score::bigint as score
from r join n on n.lang = r.lang where rank <= 2000
"""


@query("op12_collocations", PHRASE_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of each language."""
    return collocations.collocations(table(spark, sf_dir))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; texts whose crc32(doc_id) is a multiple of ten repeat a period from a word on, both given by it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(w, a):
        n = F.size(w)
        period = 1 + F.floor((n - a) / (3 + g % 8))
        rest = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % period).cast("int")))
        return F.concat_ws(" ", F.slice(w, F.lit(1), a), rest)

    # Lambdas name the words and the place, so that they are computed once.
    text = F.transform(F.array(words), lambda w: F.transform(F.array((g % F.size(w)).cast("int")), lambda a: repeated(w, a)))
    planted = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(planted, F.get(F.get(text, 0), 0)).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document after its planted period, and the digest of what is left without their repeats."""
    found = periodic.periodic_runs(with_planted_periods(table(spark, sf_dir)))
    ahead = F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(ahead)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("_best"), lines.alias("_lines"), "collapsed")
    start, length, period = -F.col("_best.s"), F.col("_best.n"), -F.col("_best.p")
    return found.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2("_lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
