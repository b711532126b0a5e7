"""Scalar text, label and format rules."""

from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import labels as lb
from echofield.functions import numbers as nm
from echofield.functions import text as tx
from echofield.operators import language_profiles as profiles
from echofield.operators import order
from echofield.plans.registry import query
from echofield.plans.views import (
    CLEANED, LEGAL_HERE, MONEY_HERE, PAIR_HERE, REVIEWS, SCORED, clean_sql, word_pattern,
)
from echofield.session import durable

def _clean(c: str) -> str:
    return clean_sql(c)


@query("h1_clean_text", f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents")
def h1(t):
    return t("documents").select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query("h1_clean_html", f"SELECT page_id, {_clean('html')} AS cleaned, {_clean('url')} AS cleaned_url FROM pages")
def h1_html(t):
    return t("pages").select(
        "page_id", tx.clean_text(F.col("html")).alias("cleaned"), tx.clean_text(F.col("url")).alias("cleaned_url")
    )


@query("h2_word_count", f"WITH {CLEANED} SELECT id, review_length FROM cleaned")
def h2(t):
    return t.cleaned.select("id", "review_length")


def _hits(lang):
    return f"len(regexp_extract_all(p, ' ({'|'.join(fixed.STOP_WORDS[lang])}) '))"


_DETECT = r"""padded AS (SELECT *, ' ' || regexp_replace(lower({c}), '[^\p{{L}}]+', '  ', 'g') || ' ' AS p FROM {src}),
    hits AS (SELECT *, %s FROM padded),
    detected AS (SELECT *, CASE WHEN 2 * len(regexp_extract_all({c}, '[\x{{0900}}-\x{{097F}}]')) > len(regexp_extract_all({c}, '\p{{L}}'))
        THEN 'hi' WHEN greatest(en, fr, de, es) = 0 THEN 'unknown' WHEN en = greatest(en, fr, de, es) THEN 'en'
        WHEN fr = greatest(en, fr, de, es) THEN 'fr' WHEN de = greatest(en, fr, de, es) THEN 'de' ELSE 'es' END AS detected_lang FROM hits)""" % (
    ", ".join(f"{_hits(x)} AS {x}" for x in fixed.STOP_WORDS)
)


@query("h3_detect_language", f"WITH {_DETECT.format(c='text', src='documents')} SELECT doc_id, lang, detected_lang FROM detected")
def h3(t):
    return t("documents").select("doc_id", "lang", tx.detect_language(F.col("text")).alias("detected_lang"))


_HELD_OUT = "substr(md5(doc_id::VARCHAR), 1, 1) < '5'"


@query("h3_profile_language", rf"""WITH base AS (SELECT doc_id, lang, text, {_HELD_OUT} AS held_out,
      ' ' || trim(regexp_replace(lower(coalesce(text, '')), '{profiles.NOT_LETTERS}', ' ', 'g')) || ' ' AS s FROM documents),
    grams AS MATERIALIZED (SELECT doc_id, lang, held_out, unnest([s[i:i + 2] for i in range(1, len(s) - 1)]) AS g FROM base),
    counted AS (SELECT lang, g, count(*) AS f FROM grams WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
    kept AS (SELECT *, 2 * sum(f) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang) + 1 AS under FROM (
      SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY lang ORDER BY f DESC, g) <= {profiles.TOP})),
    floors AS (SELECT DISTINCT lang, round(1000 * ln(1.0::DOUBLE / under))::BIGINT AS w0 FROM kept),
    weights AS (SELECT lang, g, round(1000 * ln((2 * f + 1)::DOUBLE / under))::BIGINT - w0 AS gain FROM kept JOIN floors USING (lang)),
    per AS (SELECT doc_id, g, count(*) AS c FROM grams GROUP BY ALL),
    sizes AS (SELECT doc_id, sum(c) AS n FROM per GROUP BY 1),
    gains AS (SELECT doc_id, weights.lang, sum(c * gain) AS s FROM per JOIN weights USING (g) GROUP BY ALL),
    scores AS (SELECT z.doc_id, z.n, f.lang, z.n * f.w0 + coalesce(h.s, 0) AS score FROM sizes z CROSS JOIN floors f LEFT JOIN gains h ON h.doc_id = z.doc_id AND h.lang = f.lang),
    best AS (SELECT doc_id, n, lang AS top, score - lead(score) OVER w AS lead FROM scores WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, lang) QUALIFY row_number() OVER w = 1)
    SELECT doc_id, lang, held_out, CASE WHEN 2 * len(regexp_extract_all(text, '[\x{{0900}}-\x{{097F}}]')) > len(regexp_extract_all(text, '\p{{L}}')) THEN 'hi'
      WHEN doc_id NOT IN (SELECT doc_id FROM gains) OR lead < {profiles.MARGIN} * n THEN 'unknown' ELSE top END AS detected_lang, lead::BIGINT AS lead FROM base LEFT JOIN best USING (doc_id)""")
def h3_profile(t):
    """Profiles of the documents outside the held-out fold, applied to all documents."""
    d = t("documents").select("doc_id", "lang", "text", (F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "5").alias("held_out"))
    fitted = durable(profiles.fit(d.filter("not held_out"), "text", "lang"))
    told = profiles.detect(d, "text", "doc_id", fitted)
    return d.select("doc_id", "lang", "held_out").join(told, "doc_id")


_HINGLISH = "[" + ", ".join(f"'{w}'" for w in fixed.HINGLISH_WORDS) + "]"


@query("h4_hinglish_flag", f"""WITH {CLEANED}, {_DETECT.format(c='cleaned_content', src='cleaned')} SELECT id, detected_lang = 'en' AND len(list_intersect(list_distinct(string_split(cleaned_content, ' ')), {_HINGLISH})) >= 2
    AS is_hinglish FROM detected""")
def h4(t):
    return t.cleaned.select("id", tx.is_hinglish(F.col("cleaned_content"), tx.detect_language(F.col("cleaned_content"))).alias("is_hinglish"))


@query("h5_star_bucket", f"WITH {CLEANED} SELECT id, score, star_bucket FROM cleaned")
def h5(t):
    return t.reviews.select("id", "score", lb.star_bucket(F.col("score")).alias("star_bucket"))


@query("h6_high_engagement", f"WITH {CLEANED} SELECT id, thumbs_up, high_engagement FROM cleaned")
def h6(t):
    return t.reviews.select("id", "thumbs_up", lb.high_engagement(F.col("thumbs_up")).alias("high_engagement"))


@query("h7_search_tokens", r"""SELECT doc_id, len(x)::INTEGER AS n, array_to_string(x, ' ') AS tokens FROM (
    SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+|[\x{0900}-\x{097F}]+') AS x FROM documents)""")
def h7(t):
    x = tx.search_tokens(F.col("text"))
    return t("documents").select("doc_id", F.size(x).alias("n"), F.array_join(x, " ").alias("tokens"))


@query("h8_term_tokens", rf"""WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}_]{{2,}}') AS w,
      regexp_extract_all(translate(lower(text), '{tx._MARKED}', '{tx._PLAIN}'), '[\p{{L}}\p{{N}}_]{{2,}}') AS f FROM documents)
    SELECT doc_id, len(w)::INTEGER AS n, array_to_string(w, ' ') AS tokens, array_to_string(f, ' ') AS plain_tokens,
      (2 * len(w) - CASE WHEN len(w) > 0 THEN 1 ELSE 0 END)::INTEGER AS n_grams,
      array_to_string([w[i] || ' ' || w[i + 1] for i in range(1, len(w))], ',') AS bigrams FROM x""")
def h8(t):
    w = tx.term_tokens(F.col("text"))
    f = tx.term_tokens(F.col("text"), faithful=True)
    return t("documents").select(
        "doc_id", F.size(w).alias("n"), F.array_join(w, " ").alias("tokens"), F.array_join(f, " ").alias("plain_tokens"),
        F.size(tx.ngrams(w)).alias("n_grams"), F.array_join(tx.ngrams(w, 2, 2), ",").alias("bigrams"),
    )


@query("h9_strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def h9(t):
    return t("documents").select("doc_id", tx.strip_accents_full(F.col("text")).alias("plain"))


@query("h10_weak_label", f"WITH {SCORED} SELECT id, severity_label_weak FROM scored")
def h10(t):
    return t.reviews.select("id", lb.weak_label(F.col("content"), F.col("score"), LEGAL_HERE).alias("severity_label_weak"))


@query("h11_gold_label", f"WITH {SCORED} SELECT id, severity_label_gold FROM scored")
def h11(t):
    return t.reviews.select(
        "id", lb.gold_label(F.col("content"), F.col("score"), LEGAL_HERE, PAIR_HERE).alias("severity_label_gold")
    )


@query("h12_text_shape", r"""SELECT doc_id, len(regexp_extract_all(text, '!'))::INTEGER AS exclamation_count,
    round(len(regexp_extract_all(text, '\p{Lu}')) / greatest(length(text), 1)::DOUBLE, 6) AS capital_ratio, length(text)::INTEGER AS n FROM documents""")
def h12(t):
    c = F.col("text")
    return t("documents").select(
        "doc_id", tx.exclamation_count(c).alias("exclamation_count"),
        F.round(tx.upper_ratio(c), 6).alias("capital_ratio"), F.length(c).alias("n"),
    )


def _sub_hits(terms, c="content"):
    return " + ".join(f"contains(lower({c}), '{w}')::INTEGER" for w in terms)


@query("h13_keyword_hits", f"WITH {REVIEWS} SELECT id, {_sub_hits(LEGAL_HERE)} AS legal_hits, {_sub_hits(MONEY_HERE)} AS money_hits FROM reviews")
def h13(t):
    c = F.col("content")
    return t.reviews.select(
        "id", tx.substring_hits(c, LEGAL_HERE).alias("legal_hits"), tx.substring_hits(c, MONEY_HERE).alias("money_hits")
    )


_D = fixed.DRIVER_NAMES


@query("h14_severity_drivers", f"""WITH {CLEANED}, h AS (SELECT *, {_sub_hits(LEGAL_HERE)} AS lh, {_sub_hits(MONEY_HERE)} AS mh FROM cleaned),
    e AS (SELECT id, '{_D['legal']}' AS driver, round(0.35 + 0.1 * least(lh, 2), 4)::DOUBLE AS weight FROM h WHERE lh > 0
      UNION ALL SELECT id, '{_D['money']}', round(0.22 + 0.05 * least(mh, 3), 4)::DOUBLE FROM h WHERE mh > 0
      UNION ALL SELECT id, '{_D['stars']}', 0.18 FROM h WHERE score <= 2
      UNION ALL SELECT id, '{_D['thumbs']}', 0.16 FROM h WHERE thumbs_up >= 20
      UNION ALL SELECT id, '{_D['length']}', 0.1 FROM h WHERE review_length >= 40
      UNION ALL SELECT id, '{_D['exclaim']}', 0.05 FROM h WHERE contains(content, '!')),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY weight DESC) AS r FROM e)
    SELECT id, driver, weight FROM r WHERE r <= 5
    UNION ALL SELECT id, '{_D['none']}', 0.03 FROM h WHERE id NOT IN (SELECT id FROM e)""")
def h14(t):
    drivers = lb.severity_drivers(
        F.col("content"), F.col("score"), F.col("thumbs_up"), F.col("review_length"), LEGAL_HERE, MONEY_HERE
    )
    return t.cleaned.select("id", F.inline(drivers))


@query("h15_severity_colour", f"WITH {SCORED} SELECT id, severity FROM scored")
def h15(t):
    return t.scored.select("id", lb.severity_colour(F.col("isolation_anomaly"), F.col("hdbscan_is_noise")).alias("severity"))


@query("h16_churn_proxy", f"""WITH {CLEANED} SELECT id, (star_bucket = 'complaint' AND (coalesce(score, 3) <= 1
    OR review_length >= (SELECT quantile_cont(review_length, 0.8) FROM cleaned)))::INTEGER AS churn_proxy FROM cleaned""")
def h16(t):
    limit = order.quantiles(t.cleaned.select("review_length"), "review_length", {"p80": 0.8}).select("p80")
    d = t.cleaned.withColumn("_p80", limit.scalar())
    return d.select(
        "id", lb.churn_proxy(F.col("star_bucket"), F.col("score"), F.col("review_length"), F.col("_p80")).alias("churn_proxy")
    )


@query("h17_churn_band", f"WITH {SCORED} SELECT id, churn_risk_score, churn_risk_label FROM scored")
def h17(t):
    return t.scored.select("id", "churn_risk_score", lb.churn_band(F.col("churn_risk_score")).alias("churn_risk_label"))


@query("h18_log_features", f"WITH {CLEANED} SELECT id, round(ln(1 + thumbs_up::DOUBLE), 6) AS log_thumbs, high_engagement::INTEGER AS engaged FROM cleaned")
def h18(t):
    return t.cleaned.select(
        "id", F.round(F.log1p("thumbs_up"), 6).alias("log_thumbs"), F.col("high_engagement").cast("int").alias("engaged")
    )


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_REPLIES = " UNION ALL ".join(
    f"SELECT id, '{n}' AS generator, replace({_lit(s)}, '{{route}}', route) AS response FROM r" for n, s in fixed.REPLY_TEMPLATES.items()
)
_SHORT = " UNION ALL ".join(
    f"SELECT id, 'option_{i}', replace({_lit(s)}, '{{route}}', route) FROM r" for i, s in enumerate(fixed.SHORT_REPLIES, 1)
)
_R = "r AS (SELECT id, content, coalesce(route_category, 'General') AS route FROM scored)"


@query("h19_reply_templates", f"WITH {SCORED}, {_R} {_REPLIES} UNION ALL {_SHORT}")
def h19(t):
    from echofield.operators import replies

    named = dict(fixed.REPLY_TEMPLATES) | {f"option_{i}": s for i, s in enumerate(fixed.SHORT_REPLIES, 1)}
    d = t.scored.select("id", F.coalesce("route_category", F.lit("General")).alias("route"))
    return replies.all_replies(d, "route", named).select("id", "generator", "response")


def _words(c):
    return f"list_distinct(regexp_extract_all(lower({c}), '[a-z]+'))"


def quality_sql(src: str) -> str:
    """scored replies from a CTE with columns id, generator, content, response."""
    em = "[" + ", ".join(f"'{w}'" for w in fixed.EMPATHY_WORDS) + "]"
    ac = "[" + ", ".join(f"'{w}'" for w in fixed.ACTION_WORDS) + "]"
    return f"""qw AS (SELECT *, {_words('content')} AS cw, {_words('response')} AS rw FROM {src}),
      quality AS (SELECT id, generator, response, round(0.45::DOUBLE * len(list_intersect(cw, rw)) / greatest(len(cw), 1)
        + 0.25::DOUBLE * list_has_any(rw, {em})::INTEGER + 0.3::DOUBLE * list_has_any(rw, {ac})::INTEGER
        - 0.4::DOUBLE * regexp_matches(lower(response), '{'|'.join(fixed.BLAME_WORDS)}')::INTEGER, 6) AS quality_score FROM qw)"""


@query("h20_reply_quality", f"""WITH {SCORED}, {_R}, g AS (SELECT id, 'template_v1' AS generator, content, replace({_lit(fixed.REPLY_TEMPLATES['template_v1'])}, '{{route}}', route) AS response FROM r),
    {quality_sql('g')} SELECT id, quality_score FROM quality""")
def h20(t):
    response = lb.reply(fixed.REPLY_TEMPLATES["template_v1"], F.coalesce("route_category", F.lit("General")))
    return t.scored.select("id", F.round(lb.reply_quality(F.col("content"), response), 6).alias("quality_score"))


@query("h21_short_id", "SELECT o_orderkey, 'R' || CASE WHEN o_orderkey > 9999 THEN o_orderkey::VARCHAR ELSE lpad(o_orderkey::VARCHAR, 4, '0') END AS sid FROM orders")
def h21(t):
    return t("orders").select("o_orderkey", tx.short_id(F.col("o_orderkey")).alias("sid"))


_ANSWER_SQL = """answers AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'Sorry. not enough evidence in the retrieved reviews to answer this'
      ELSE substr(text, 1, 40) || ' [R' || lpad((conv_id % 50)::VARCHAR, 4, '0') || '][R' || (10000 + turn) || '] [R' || lpad((conv_id % 50)::VARCHAR, 4, '0') || ']' END AS answer FROM conversations)"""


def _answers(t):
    pad = F.lpad((F.col("conv_id") % 50).cast("string"), 4, "0")
    cited = F.concat(
        F.substring("text", 1, 40), F.lit(" [R"), pad, F.lit("][R"), (F.col("turn") + 10000).cast("string"),
        F.lit("] [R"), pad, F.lit("]"),
    )
    refused = F.lit("Sorry. not enough evidence in the retrieved reviews to answer this")
    return t("conversations").select("conv_id", "turn", F.when(F.col("turn") % 5 == 0, refused).otherwise(cited).alias("answer"))


@query("h22_citation_ids", f"""WITH {_ANSWER_SQL} SELECT conv_id, turn, array_to_string(regexp_extract_all(answer, 'R\\d{{4,}}')[:2], ',') AS cited FROM answers""")
def h22(t):
    return _answers(t).select("conv_id", "turn", F.array_join(tx.citations(F.col("answer")), ",").alias("cited"))


@query("h23_refusals", f"WITH {_ANSWER_SQL} SELECT conv_id, turn, contains(lower(answer), 'not enough evidence in the retrieved reviews to answer this') AS refused FROM answers")
def h23(t):
    return _answers(t).select("conv_id", "turn", tx.is_refusal(F.col("answer")).alias("refused"))


@query("h24_context_lines", f"""WITH {SCORED} SELECT id, '[' || sid || '] (platform=' || platform || ', rating=' || coalesce(score::VARCHAR, 'None') || ', date=' || strftime("at", '%Y-%m-%d')
    || ', severity=' || severity || ', team=' || coalesce(route_category, 'None') || ') ' || regexp_replace(content, '^\\s+|\\s+$', '', 'g') AS line FROM scored""")
def h24(t):
    line = tx.context_line(
        F.col("sid"), F.col("platform"), F.col("score"), F.to_date("at"), F.col("severity"), F.col("route_category"), F.col("content")
    )
    return t.scored.select("id", line.alias("line"))


@query("h25_plain_dashes", """WITH d AS (SELECT doc_id, replace(replace(replace(text, '. ', ' — '), ', ', '–'), 'er', 'e‑r') AS t FROM documents)
    SELECT doc_id, replace(replace(replace(replace(replace(t, ' — ', ': '), '—', ', '), ' – ', ': '), '–', ', '), '‑', '-') AS plain FROM d""")
def h25(t):
    c = F.col("text")
    for a, b in ((". ", " — "), (", ", "–"), ("er", "e‑r")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return t("documents").select("doc_id", tx.plain_dashes(c).alias("plain"))


@query("h26_set_signature", """SELECT label, md5('c' || string_agg('R' || lpad(vec_id::VARCHAR, 4, '0'), ',' ORDER BY vec_id)) AS signature FROM (
    SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 12 GROUP BY 1""")
def h26(t):
    from echofield.operators import pick, worklist

    first = pick.top_per_group(t("embeddings").withColumn("_o", -F.col("vec_id")), "label", "_o", "vec_id", 12)
    members = first.select("label", "rank", tx.short_id(F.col("vec_id")).alias("sid"))
    return worklist.signatures(members, ["label"], "sid", "rank", prefix=F.lit("c")).select("label", "signature")


@query("h27_score_bands", f"""WITH {REVIEWS} SELECT id, CASE WHEN s > 0 AND s <= 2 THEN '1-2' WHEN s > 2 AND s <= 3 THEN '3' WHEN s > 3 AND s <= 5 THEN '4-5' END AS band
    FROM (SELECT id, coalesce(score, 3) AS s FROM reviews)""")
def h27(t):
    band = tx.right_closed_band(F.coalesce("score", F.lit(3.0)), [0, 2, 3, 5], ["1-2", "3", "4-5"])
    return t.reviews.select("id", band.alias("band"))


@query("h28_text_cuts", "SELECT doc_id, substr(text, 1, 120) AS c120, substr(text, 1, 180) || '...' AS c180, substr(text, 1, 400) AS c400 FROM documents")
def h28(t):
    c = F.col("text")
    return t("documents").select("doc_id", tx.cut(c, 120).alias("c120"), tx.cut(c, 180, "...").alias("c180"), tx.cut(c, 400).alias("c400"))


@query("h29_clip_and_round", "SELECT event_id, greatest(1, least(5, value)) AS clipped, round_even(value / 8, 3) AS rounded FROM events")
def h29(t):
    v = F.col("value")
    return t("events").select(
        "event_id", nm.clip(v, 1.0, 5.0).alias("clipped"), nm.round_even(v / 8, 3).alias("rounded")
    )
