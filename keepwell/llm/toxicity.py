"""Toxicity by a weighted finite-state grammar over clauses.

Parts: a lexicon transducer reads words and emits the classes insult (with a weight per word or stem), threat, target,
negation and report; clause transducers read the classes of one clause. Each clause transducer scales what an insult or
threat is worth: a target in reach strengthens it, a negation shortly before it or a reporting verb or quotation mark
before it weakens it. They run composed, as one machine over tuples of states whose factors multiply. A text's evidence is
the sum over its distinct insulting and threatening words of the best clause they were matched in; a logistic turns it into the score.

The lexicon is a general word list plus words and stems learned from labelled texts: prefixes whose document frequencies
in toxic and clean texts differ significantly, in their longest form that loses nothing, taken in the order of their
evidence from texts that the entries before them leave unexplained. Learning uses at most `sample`
labelled rows, chosen by a hash of their id among those whose crc32(id) mod 5 is not 0. Only the text enters a score.

Whole texts are scanned. A null or empty text has no evidence and gets the score of none. Repeated label rows count once, toxic if
any of them says so; labels without a document are ignored. Without usable labels the general list is used alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 16_000  #: labelled rows to learn from, at most
LEAST_DOCS, LEAST_G, LEAST_ODDS = 3, 24.0, math.log(8)
LONGEST, SHORTEST, LARGEST_LEXICON = 10, 3, 20_000
EXPLAINED = 0.15  #: weight that a toxic text keeps after each entry learned from it
GENERAL_WEIGHT, THREAT_WEIGHT = 4.0, 3.0

#: fixed values: general words, by class
INSULTS = ("idiot moron imbecile stupid dumb fool loser clown scum trash worthless pathetic disgusting filthy vermin "
           "dummkopf trottel abschaum dreckskerl imbécile crétin abruti connard estúpido imbécil basura escoria").split()
THREATS = "kill hurt destroy beat smash burn strangle töten umbringen tuer frapper matar golpear".split()
TARGETS = ("you your yours u he she they them him her this that these those everyone people du ihr euch sie dich tu vous toi "
           "usted ustedes ellos ella").split()
NEGATIONS = "not no never isn aren wasn don doesn didn cannot nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = ("said says say called calls wrote writes claimed reported quoted quote told sagte schrieb nannte zitierte dit "
           "écrit appelé dijo escribió llamó").split()

_WORD = re.compile(r"[^\W\d_]+|[\"“”„«»]")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_ENDS = ".!?;:\n"


class Transducer(NamedTuple):
    """Moves on classes; a state's factor applies to an insult or threat read in it."""
    start: str
    moves: dict[tuple[str, str], str]
    factors: dict[str, float]

    def step(self, state: str, kind: str) -> str:
        return self.moves.get((state, kind), self.moves.get((state, "*"), state))


NEGATED = Transducer("free", {("free", "negation"): "n3", ("n1", "negation"): "n3", ("n2", "negation"): "n3", ("n3", "negation"): "n3",
                              ("n3", "*"): "n2", ("n2", "*"): "n1", ("n1", "*"): "free"}, {"n3": 0.4, "n2": 0.4, "n1": 0.4})
REPORTED = Transducer("own", {("own", "report"): "told", ("own", "quote"): "quoted", ("told", "quote"): "quoted", ("quoted", "quote"): "own"},
                      {"told": 0.6, "quoted": 0.8})
AIMED = Transducer("open", {("open", "target"): "aimed"}, {"aimed": 1.1})
GRAMMAR = (NEGATED, REPORTED, AIMED)


def run_clause(kinds: Iterable[tuple[str, str, float]], grammar: tuple[Transducer, ...] = GRAMMAR) -> dict[str, float]:
    """Scores of the insults and threats of one clause, read once as (class, entry, weight), by the composed transducers. What is
    kept are their states and the entries found, so a clause may have any length. Threats count where the clause has a target."""
    states, found, threats, aimed = [t.start for t in grammar], {}, {}, False
    for kind, entry, weight in kinds:
        if kind in ("insult", "threat"):
            worth, into = weight * math.prod(t.factors.get(s, 1.0) for t, s in zip(grammar, states, strict=True)), found if kind == "insult" else threats
            into[entry] = max(into.get(entry, 0.0), worth)
        aimed = aimed or kind == "target"
        states = [t.step(s, kind) for t, s in zip(grammar, states, strict=True)]
    return found | {entry: max(worth, found.get(entry, 0.0)) for entry, worth in threats.items()} if aimed else found


class Model(NamedTuple):
    insults: dict[str, float]  #: word (ending in $) or stem -> weight
    slope: float
    base: float


class Scorer:
    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.classes = {w: k for k, words in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in words}
        self.spotted = ahocorasick.Automaton()
        for entry in {*(e.rstrip("$") for e in model.insults), *THREATS}:
            self.spotted.add_word(entry, len(entry))
        self.spotted.make_automaton()

    def _kind(self, word: str) -> tuple[str, str, float]:
        for end in (f"{word}$", *(word[:k] for k in range(min(len(word), LONGEST), SHORTEST - 1, -1))):
            if (weight := self.model.insults.get(end)) is not None:
                return "insult", word, weight
        kind = self.classes.get(word, "quote" if not word.isalpha() else "other")
        return kind, word, THREAT_WEIGHT if kind == "threat" else 0.0

    def evidence(self, text: str | None) -> float:
        if not text:
            return 0.0
        text, best, done = text.lower(), {}, 0
        for last, length in self.spotted.iter(text):
            start = last - length + 1
            if start < done or start and (text[start - 1].isalpha()):
                continue
            low = max(done, *(text.rfind(end, done, start) + 1 for end in _ENDS))
            stop = _CLAUSE_END.search(text, last + 1)
            done = stop.start() if stop else len(text)
            for entry, worth in run_clause(self._kind(m[0]) for m in _WORD.finditer(text, low, done)).items():
                best[entry] = max(best.get(entry, 0.0), worth)
        return sum(best.values())

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.model.base + self.model.slope * self.evidence(text)))))


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the sampled labelled rows. The sample is at most `sample` ids, so it is broadcast to the documents."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    return (docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).dropDuplicates(["_id"])
            .select(F.col(text_col).alias("text"), "toxic"))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) -> (entry, toxic, clean): document frequencies of words and prefixes, summed per batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for w in _WORD.findall((text or "").lower()) if len(w) >= SHORTEST}
            found = {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}
            counts[int(bool(toxic))].update(found | {f"{w}$" for w in words})
        entries = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array([counts[1][e] for e in entries], pa.int64()),
                                          pa.array([counts[0][e] for e in entries], pa.int64())], names=["entry", "toxic", "clean"])


def significant(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Entries far more frequent in toxic texts: log odds and a log-likelihood ratio."""
    a, b = F.col("toxic"), F.col("clean")
    odds = F.log((a + 0.5) / F.lit(toxic + 1.0)) - F.log((b + 0.5) / F.lit(clean + 1.0))
    share = (a + b) / F.lit(float(toxic + clean))

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    g = 2 * (part(a, share * toxic) + part(b, share * clean) + part(toxic - a, (1 - share) * toxic) + part(clean - b, (1 - share) * clean))
    return (counts.where(a >= LEAST_DOCS).withColumn("odds", odds).withColumn("g", g)
            .where((F.col("odds") >= LEAST_ODDS) & (F.col("g") >= LEAST_G)))


def lexicon(rows: list[tuple[str, int, int, float]]) -> dict[str, tuple[int, float]]:
    """From significant (entry, toxic, clean, odds): a stem in its longest form that keeps its texts; longer entries only where
    they are purer than the stem they extend."""
    known = {e: (a, b, w) for e, a, b, w in rows}
    longer: dict[str, list[str]] = {}
    for e in known:
        longer.setdefault(e[:-1], []).append(e)
    stems = {}
    for e, (a, b, w) in known.items():
        if any(known[x][0] >= 0.97 * a and known[x][1] <= b for x in longer.get(e, ())):
            continue
        stems[e] = (a, b, w)
    kept: dict[str, tuple[int, float]] = {}
    for e in sorted(stems, key=lambda x: (len(x), x)):
        a, b, w = stems[e]
        shorter = [stems[e[:k]] for k in range(SHORTEST, len(e)) if e[:k] in kept]
        if not any(sa / (sa + sb) >= a / (a + b) - 0.02 for sa, sb, _ in shorter):
            kept[e] = b, w
    return kept


def covering(candidates: dict[str, tuple[int, float]], found: list[list[str]], toxic: int, clean: int) -> dict[str, float]:
    """Candidates (entry -> clean texts, odds) that explain toxic texts which better ones leave unexplained. `found` lists the
    candidates in each toxic text. A text counts EXPLAINED as much for each entry taken from it, so the words that a group of
    copies merely shares don't count as evidence beside the insult that its texts were marked for."""
    worth = np.ones(len(found))
    places: dict[str, list[int]] = {}
    for i, entries in enumerate(found):
        for e in entries:
            places.setdefault(e, []).append(i)
    arrays = {e: np.array(v) for e, v in places.items()}
    waiting = {e: _g(float(len(v)), candidates[e][0], toxic, clean) for e, v in arrays.items()}
    kept: dict[str, float] = {}
    while waiting:
        entry = max(waiting, key=lambda e: (waiting[e], e))
        support = worth[arrays[entry]].sum()
        now = _g(support, candidates[entry][0], toxic, clean) if support >= LEAST_DOCS else 0.0
        if now < LEAST_G:
            del waiting[entry]
        elif now < waiting[entry]:  # others have explained some of its texts meanwhile
            waiting[entry] = now
        else:
            del waiting[entry]
            kept[entry] = candidates[entry][1]
            worth[arrays[entry]] *= EXPLAINED
    return kept


def _g(a: float, b: float, toxic: int, clean: int) -> float:
    """Log-likelihood ratio of a in toxic and b in clean texts, if in favour of toxic."""
    share = (a + b) / (toxic + clean)
    if a * clean <= b * toxic or share >= 1:
        return 0.0
    parts = ((a, share * toxic), (b, share * clean), (toxic - a, (1 - share) * toxic), (clean - b, (1 - share) * clean))
    return 2 * sum(n * math.log(n / e) for n, e in parts if n > 0)


def _holding(entries: frozenset[str]):
    """(text, toxic) -> the entries in each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words = {w for w in _WORD.findall((text or "").lower()) if len(w) >= SHORTEST}
                out.append(sorted(entries & ({w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)} | {f"{w}$" for w in words})))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["entries"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base by Newton steps with a weak prior around (1, -2)."""
    beta, prior = np.array([1.0, -2.0]), np.array([1.0, -2.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - (beta - prior)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.eye(2), gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 0.05)), float(beta[1])


def train(rows: DataFrame) -> Model:
    """A model from (text, toxic) rows, at most SAMPLE of them; what reaches the driver is the lexicon and a number per row."""
    rows = rows.persist()
    try:
        sizes = {r.toxic: r["count"] for r in rows.where("toxic is not null").groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
        toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
        insults = {f"{w}$": GENERAL_WEIGHT for w in INSULTS}
        if not toxic or not clean:
            return Model(insults, 1.0, -2.0)
        counts = rows.mapInArrow(_prefixes, "entry string, toxic long, clean long").groupBy("entry").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        best = significant(counts, toxic, clean).orderBy(F.desc("g"), "entry").limit(LARGEST_LEXICON)
        candidates = lexicon([(r.entry, r.toxic, r.clean, r.odds) for r in best.collect()])
        found = rows.where("toxic > 0").mapInArrow(_holding(frozenset(candidates)), "entries array<string>").collect()
        insults |= covering(candidates, [r.entries for r in found], toxic, clean)
        made = Model(insults, 1.0, -2.0)
        pairs = rows.mapInArrow(_evidence(made), "evidence double, toxic int").collect()
        return Model(insults, *_logistic(np.array([p.evidence for p in pairs]), np.array([float(p.toxic > 0) for p in pairs])))
    finally:
        rows.unpersist()


def _evidence(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([scorer.evidence(t) for t in batch.column(0).to_pylist()], pa.float64()), batch.column(1)],
                                             names=["evidence", "toxic"])
    return run


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` with the score of each text; no row moves."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = pa.array([scorer.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
