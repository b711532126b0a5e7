"""Trigram profiles: exact scores against a slow version, languages apart, and rows without a decision."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from echofield.operators import language_profiles as lp

SENTENCES = {
    "it": ["il servizio clienti non risponde mai alle richieste", "questa applicazione funziona molto bene ogni giorno", "ho perso tutti i soldi che avevo nel conto"],
    "nl": ["de klantenservice geeft nooit antwoord op mijn vragen", "deze toepassing werkt elke dag heel goed voor mij", "ik heb al het geld van mijn rekening verloren"],
    "pt": ["o atendimento nunca responde aos meus pedidos de ajuda", "este aplicativo funciona muito bem todos os dias", "perdi todo o dinheiro que tinha na minha conta"],
    "sv": ["kundtjänsten svarar aldrig på mina frågor", "den här appen fungerar väldigt bra varje dag", "jag har förlorat alla pengar på mitt konto"],
}
NEW = {
    "it": "la richiesta del cliente non funziona ogni giorno", "nl": "ik geef elke dag antwoord op vragen van de klant",
    "pt": "perdi os meus dias com este atendimento", "sv": "jag har aldrig fungerat bra på frågor",
}


def grams(text):
    s = " " + re.sub(r"[^a-zà-ÿ]+", " ", (text or "").lower()).strip() + " "
    return [s[i : i + 3] for i in range(len(s) - 2)]


def fitted(spark, top=lp.TOP):
    rows = [(s, lang) for lang, many in SENTENCES.items() for s in many]
    return lp.fit(spark.createDataFrame([*rows, ("no label here", None), (None, "it"), ("", "xx")], "text string, lang string"), "text", "lang", top)


def test_profiles_and_scores_equal_a_slow_version(spark):
    top = 40
    slow = {}
    for lang, many in SENTENCES.items():
        kept = sorted(Counter(g for s in many for g in grams(s)).items(), key=lambda x: (-x[1], x[0].encode()))[:top]
        under = 2 * sum(f for _, f in kept) + len(kept) + 1
        slow[lang] = {g: round(1000 * math.log((2 * f + 1) / under)) for g, f in kept} | {"": round(1000 * math.log(1 / under))}
    table = fitted(spark, top)
    assert {(r.lang, r.gram): r.weight for r in table.collect()} == {(k, g): w for k, p in slow.items() for g, w in p.items()}
    got = lp.detect(spark.createDataFrame(list(NEW.items()), "k string, text string"), "text", "k", table, 0).collect()
    for r in got:
        scores = sorted(((sum(p.get(g, p[""]) for g in grams(NEW[r.k])), lang) for lang, p in slow.items()), key=lambda x: (-x[0], x[1]))
        assert (r.detected_lang, r.lead) == (scores[0][1], scores[0][0] - scores[1][0])


def test_languages_beyond_the_word_lists_are_told_apart(spark):
    got = lp.detect(spark.createDataFrame(list(NEW.items()), "k string, text string"), "text", "k", fitted(spark)).collect()
    assert {r.k: r.detected_lang for r in got} == {k: k for k in NEW}


def test_rows_without_a_decision_long_texts_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, "12 !! 34"), (4, "यह बहुत अच्छा है"), (5, "zzqx kkwv xxqz"), (6, NEW["nl"] + " " + "klantenservice antwoord " * 20_000), (7, "𝔞𝔟𝔠𝔡")]
    docs = spark.createDataFrame(rows, "gram int, weight string").withColumn("lang", F.lit("q")).withColumn("_n", F.lit(1))
    got = {r.gram: r.detected_lang for r in lp.detect(docs, "weight", "gram", fitted(spark)).collect()}
    assert {k: v for k, v in got.items() if k != 5} == {1: "unknown", 2: "unknown", 3: "unknown", 4: "hi", 6: "nl", 7: "unknown"}
    none = fitted(spark).limit(0)
    assert {r.detected_lang for r in lp.detect(docs.filter("gram <> 4"), "weight", "gram", none).collect()} == {"unknown"}
    assert lp.detect(docs.limit(0), "weight", "gram", fitted(spark)).collect() == []
    one = lp.detect(docs, "weight", "gram", fitted(spark).filter("lang = 'nl'")).filter("gram = 6").first()
    assert (one.detected_lang, one.lead) == ("nl", None)
