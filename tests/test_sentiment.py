"""The fold over words against unseen sentences and a plain reading of its rules."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from keepwell.operators import insight, sentiment
from keepwell.operators.sentiment import BLAME, CONTRAST, NEGATION, PRAISE, STRONG, WEAK


def _read(spark, texts, languages=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("s", sentiment.folded(F.col("t"), languages))
    return [(r.total, r.hits, r.v) for r in df.select("i", "s.total", "s.hits", sentiment.verdict(F.col("s")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("language, positive, negative", [
    ("en", ["A wonderful, sturdy chair.", "The lamp is not bad at all.", "Parcel was damaged but the staff were extremely helpful."],
     ["Absolutely useless!", "I would never call this a good kettle.", "The colour is beautiful, however the zip is faulty."]),
    ("de", ["Sehr bequem und schön.", "Gar nicht schlecht!", "Der Karton war kaputt, aber der Stuhl ist ausgezeichnet."],
     ["Das ist wirklich enttäuschend.", "Keine gute Lampe.", "Die Farbe ist toll, jedoch ist der Griff defekt."]),
    ("fr", ["TRÈS confortable, je suis satisfait.", "Ce n'est pas mauvais.", "La boîte est laid mais le produit est parfait."],
     ["Vraiment décevant.", "Il n'est pas fiable.", "Un joli goût agréable, pourtant le bouton est cassé."]),
    ("es", ["Muy cómodo y útil.", "No es malo.", "La caja llegó roto pero la silla es excelente."],
     ["Sumamente decepcionante.", "Nunca fue una buena compra.", "El color es agradable, aunque el cierre es defectuoso."])])
def test_unseen_sentences(spark, language, positive, negative):
    for languages in (None, [language]):
        assert [v for _, _, v in _read(spark, positive + negative, languages)] == ["positive"] * 3 + ["negative"] * 3


def test_edges(spark):
    # null, empty and blank; a word inside another; a negation ends with its sentence; an accent is part of a word
    texts = [None, "", " \n ", "goodness badly", "Not. Good.", "not a b c d good", "not a b c good", "very good", "fairly good", "good bad"]
    assert [t for t, _, _ in _read(spark, texts)] == [0, 0, 0, 0, 4, 4, -2, 6, 2, 0]
    assert _read(spark, ["so " * 50_000 + "awful"])[0] == (-4, 1, "negative")  # whole texts


def _plain(text):
    """The rules sentence by sentence, looking back from every word of praise or blame."""
    table, total, hits = sentiment.kinds(), 0, 0
    for sentence in re.split(r"[.!?;\n]", text.lower()):
        words = [table.get(w, "") for w in re.findall(r"[^\W\d_]+", sentence)]
        cut = max((i for i, k in enumerate(words) if k == CONTRAST), default=-1)
        halves = [0, 0]
        for i, kind in enumerate(words):
            if kind not in (PRAISE, BLAME):
                continue
            hits += 1
            degree = {STRONG: 3, WEAK: 1}.get(words[i - 1] if i else "", 2)
            negated = False
            for k in reversed(words[max(0, i - sentiment.SCOPE):i]):
                if k in (PRAISE, BLAME, CONTRAST):
                    break
                negated = negated or k == NEGATION
            halves[i > cut] += (1 if kind == PRAISE else -1) * (-degree if negated else 2 * degree)
        total += halves[0] + 2 * halves[1] if halves[0] else halves[1]
    return total, hits


def test_the_fold_equals_a_plain_reading(spark):
    rng, words = random.Random(5), [*sentiment.kinds(), *["chair", "x"] * 60, *".!?;\n" * 4]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert [(t, h) for t, h, _ in _read(spark, texts)] == [_plain(t) for t in texts]


def test_as_a_scorer_of_reviews(spark):
    df = spark.createDataFrame([("Not a good lamp.",), ("superb",), ("a lamp",)], "review_text string")
    rows = insight.parsed(insight.score(df, sentiment.fold_scorer())).collect()
    assert [r.sentiment for r in rows] == ["negative", "positive", "neutral"]
    assert [json.loads(r.issues) for r in rows] == [[], [], []] and [r.sentiment_score for r in rows] == [0.67, 0.83, 0.5]
