"""Sentiment of a text read word by word: praise and blame under negation, degree and contrast, in four languages.

One tokenisation, then one fold over the words (`aggregate`), all of it in column expressions: no Python, no shuffle, whole texts.
A word of praise or blame counts 2, 3 after a strengthening word and 1 after a weakening one; a negation up to SCOPE words before
it turns it round at half its size ("not good" is weaker than "bad"). A word of contrast ("but") sets what came before in the
sentence against what follows, which counts twice. Sentences add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SCOPE = 4
WORDS = r"\p{L}+|[.!?;\n]"
STOP, PRAISE, BLAME, NEGATION, STRONG, WEAK, CONTRAST = "stop", "praise", "blame", "negation", "strong", "weak", "contrast"

# fixed values: general words by language
LEXICON = {
    "en": {PRAISE: "good great excellent wonderful superb reliable comfortable delighted sturdy pleasant beautiful perfect helpful satisfied",
           BLAME: "bad awful horrible useless flimsy faulty defective annoying disappointing ugly worst unacceptable stupid damaged",
           NEGATION: "not no never nothing neither cannot hardly", STRONG: "very really extremely absolutely totally", WEAK: "slightly somewhat fairly rather",
           CONTRAST: "but however although"},
    "de": {PRAISE: "gut gute toll ausgezeichnet wunderbar zuverlässig bequem schön perfekt hilfreich zufrieden",
           BLAME: "schlecht schlechte furchtbar schrecklich nutzlos defekt kaputt ärgerlich enttäuschend hässlich mangelhaft",
           NEGATION: "nicht kein keine nie niemals", STRONG: "sehr wirklich äußerst absolut", WEAK: "etwas ziemlich", CONTRAST: "aber jedoch obwohl"},
    "fr": {PRAISE: "bon bonne excellent excellente merveilleux fiable confortable agréable parfait utile satisfait",
           BLAME: "mauvais mauvaise horrible affreux inutile défectueux cassé décevant laid pénible",
           NEGATION: "pas jamais rien aucun", STRONG: "très vraiment extrêmement", WEAK: "peu assez", CONTRAST: "mais cependant pourtant"},
    "es": {PRAISE: "bueno buena excelente maravilloso fiable cómodo agradable perfecto útil satisfecho",
           BLAME: "malo mala horrible terrible inútil defectuoso roto decepcionante feo pésimo",
           NEGATION: "no nunca nada tampoco", STRONG: "muy realmente sumamente", WEAK: "algo bastante", CONTRAST: "pero aunque sino"},
}
STATE = "struct<before:int,now:int,total:int,hits:int,scope:int,degree:int>"


def kinds(languages: list[str] | None = None) -> dict[str, str]:
    """Word -> kind; a word of several languages keeps the kind of the first that lists it."""
    found: dict[str, str] = {}
    for language in languages or list(LEXICON):
        for kind, words in LEXICON[language].items():
            for word in words.split():
                found.setdefault(word, kind)
    return found


def _kind(word: Column, table: dict[str, str]) -> Column:
    """Membership is a hash test for each kind; words of no kind are null."""
    of = {k: [w for w, kind in table.items() if kind == k] for k in (PRAISE, BLAME, NEGATION, STRONG, WEAK, CONTRAST)}
    arms = [F.when(word.isin(words), k) for k, words in of.items() if words]
    return F.coalesce(F.when(word.isin(".", "!", "?", ";", "\n"), STOP), *arms)


def _step(state: Column, kind: Column) -> Column:
    """The state after one word. `before` holds the sentence up to a contrast, `now` what follows it, `total` the sentences that have ended."""
    signed = F.when(kind == PRAISE, 1).when(kind == BLAME, -1)
    value = signed * F.when(state["scope"] > 0, -state["degree"]).otherwise(2 * state["degree"])
    ends, turns, hit = kind == STOP, kind == CONTRAST, kind.isin(PRAISE, BLAME)

    def when(*arms, otherwise):
        return F.coalesce(*[F.when(test, then) for test, then in arms], otherwise).cast("int")
    return F.struct(
        when((ends, F.lit(0)), (turns, state["before"] + state["now"]), otherwise=state["before"]).alias("before"),
        when((ends | turns, F.lit(0)), (hit, state["now"] + value), otherwise=state["now"]).alias("now"),
        when((ends, state["total"] + _sentence(state)), otherwise=state["total"]).alias("total"),
        when((hit, state["hits"] + 1), otherwise=state["hits"]).alias("hits"),
        when((ends | turns | hit, F.lit(0)), (kind == NEGATION, F.lit(SCOPE)), otherwise=F.greatest(state["scope"] - 1, F.lit(0))).alias("scope"),
        # a degree holds for the next word only
        when((kind == STRONG, F.lit(3)), (kind == WEAK, F.lit(1)), otherwise=F.lit(2)).alias("degree")).cast(STATE)


def _sentence(state: Column) -> Column:
    """A contrast makes what follows count twice; without one nothing came before."""
    return F.when(state["before"] != 0, state["before"] + 2 * state["now"]).otherwise(state["now"])


def folded(text: Column, languages: list[str] | None = None) -> Column:
    """struct(total, hits): the balance of a text, positive for praise, and how many words of praise or blame it holds. Null text: 0, 0."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))
    table = kinds(languages)
    start = F.struct(*[F.lit(2 if c == "degree" else 0).alias(c) for c in ("before", "now", "total", "hits", "scope", "degree")]).cast(STATE)

    def end(state: Column) -> Column:
        return F.struct((state["total"] + _sentence(state)).alias("total"), state["hits"].alias("hits"))
    return F.aggregate(F.transform(words, lambda w: F.coalesce(_kind(w, table), F.lit(""))), start, _step, end)


def verdict(score: Column) -> Column:
    return F.when(score["total"] > 0, "positive").when(score["total"] < 0, "negative").otherwise("neutral")


def fold_scorer(issues: Callable[[Column], Column] | None = None, languages: list[str] | None = None) -> Callable[[Column], Column]:
    """Scorer for `insight.score`: the verdict, its share of the largest balance so many words can have, and the named issues."""
    def score(text: Column) -> Column:
        read = folded(text, languages)
        found = issues(text) if issues else F.lit([]).cast("array<string>")
        lead = F.least(F.abs(read["total"]) / F.greatest(6 * read["hits"], F.lit(1)), F.lit(1.0))
        return F.to_json(F.struct(verdict(read).alias("sentiment"), F.round((lead + 1) / 2, 2).alias("score"), found.alias("issues")))
    return score
