"""Inputs on which an operator once stalled, crashed, lost a row or stopped reading."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keepwell.llm import minhash, mixing, tokens, toxicity
from keepwell.session import scratch_path


# ---------------------------------------------------------------- 10
@pytest.fixture(scope="module")
def scorer():
    return toxicity.Scorer(toxicity.Model({"idiot$": 4.0, "moron$": 4.0}, 1.0, -2.0))


@pytest.mark.parametrize("gap", [0, 1, 106, 390, 398, 399, 400, 401, 402, 404, 506, 5_000])
def test_clauses_are_read_whole(scorer, gap):
    filler = ("ab " * (gap // 3 + 1))[:gap]
    assert scorer.evidence(f"idiot {filler} moron") == 8.0
    assert scorer.evidence(f"kill {filler} you") == 3.0
    assert scorer.evidence(f"kill {filler}. you") == 0.0
    assert scorer.evidence(f"you {filler} kill") == pytest.approx(3.3)
    assert scorer.evidence(f"He said {filler} idiot") == pytest.approx(2.4 * 1.1)
    assert scorer.evidence(f"one. not {filler} x. idiot") == 4.0


def test_a_clause_of_a_million_words_is_read_once(scorer):
    start = time.time()
    text = "kill " + "idiot word moron " * 400_000 + "you"
    assert scorer.evidence(text) == 11.0
    assert time.time() - start < 20


def test_every_path_of_the_composed_grammar_equals_a_plain_reading():
    from itertools import product

    def plainly(kinds):
        best, negated, told = {}, 0, "own"
        for i, kind in enumerate(kinds):
            if kind == "insult" or kind == "threat" and "target" in kinds:
                worth = 4.0 * (0.4 if negated else 1.0) * {"own": 1.0, "told": 0.6, "quoted": 0.8}[told] * (1.1 if "target" in kinds[:i] else 1.0)
                best[kind] = max(best.get(kind, 0.0), worth)
            negated = 3 if kind == "negation" else max(0, negated - 1)
            if kind == "report" and told == "own":
                told = "told"
            elif kind == "quote":
                told = "own" if told == "quoted" else "quoted"
        return best
    names = ["insult", "threat", "target", "negation", "report", "quote", "other"]
    for n in range(1, 6):
        for kinds in product(names, repeat=n):
            got = toxicity.run_clause((k, k, 4.0) for k in kinds)
            assert got == pytest.approx(plainly(kinds)), kinds


# ---------------------------------------------------------------- 5
def test_mixing_keeps_columns_of_any_name(spark):
    kind = "doc_id long, text string, source string, rate double, seed int, copy_no int, key string, `a.b` int, `times` int, row int, _source string"
    rows = [(i, "w " * (i % 7 + 1), "ab"[i % 2], 0.5, 1, 99, "k", 2, 3, 4, "s") for i in range(60)]
    docs = spark.createDataFrame(rows, kind)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [*[c for c in docs.columns if c != "copy_no"], "copy_no"]
    got = mixed.collect()
    assert {(r.rate, r.seed, r.key, r["a.b"], r.times, r.row, r._source) for r in got} == {(0.5, 1, "k", 2, 3, 4, "s")}
    times = {r.id: r.copies for r in mixing.mixture(docs).collect() if r.copies}
    counted = {}
    for r in got:
        counted.setdefault(r.doc_id, []).append(r.copy_no)
    assert {i: sorted(n) for i, n in counted.items()} == {i: list(range(n)) for i, n in times.items()}


# ---------------------------------------------------------------- 6
def prose(seed, n=120):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]


def changed(words, *places):
    return " ".join("new" if i in places else w for i, w in enumerate(words))


@pytest.mark.parametrize("turn", [1, -1])
def test_an_id_with_two_texts_is_linked_through_either(spark, turn):
    one, two = prose(1), prose(2)
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, changed(one, 60)), (3, changed(two, 60)), (3, changed(two, 60)), (4, " ".join(prose(3))),
            (None, " ".join(one)), (6, None), (7, "")][::turn]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.id, r.component_id, r.kept) for r in minhash.near_duplicates(docs.repartition(3), words=4).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (None, None, True), (6, 6, True), (7, 7, True)}


def test_columns_of_the_operator_in_the_table(spark):
    kind = "doc_id long, text string, id int, digest string, number int, class int, n int, first int, component int"
    docs = spark.createDataFrame([(i, " ".join(prose(i % 2)), 1, "d", 2, 3, 4, 5, 6) for i in range(6)], kind)
    assert {(r.id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(i, i % 2) for i in range(6)}


# ---------------------------------------------------------------- pipeline
def stage(spark, name, rows, benchmark=()):
    path = scratch_path(spark, "stage-edges")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), 0.5, 9) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, rate double, row_number int")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, path)
    assert out.columns[:7] == docs.columns
    return sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=str)


def test_contaminated_rows_go_whatever_their_id(spark):
    item, clean = " ".join(prose(5, 30)), " ".join(prose(6))
    leaked = f"{clean} {item}"
    rows = [(None, leaked, "a"), (None, clean, "a"), (1, leaked, "a"), (1, clean, "b"), (2, clean, "a"), (2, clean, "a"), (3, None, "a"), (None, None, None), (4, "", "a")]
    got = stage(spark, "benchmark decontamination", rows, [(0, item)])
    assert got == sorted(((i, t, s) for i, t, s in rows if t != leaked), key=str)


def test_one_of_each_group_stays_whatever_the_ids(spark):
    text, other = " ".join(prose(7)), " ".join(prose(8))
    rows = [(None, text, "a"), (None, text, "b"), (5, text, "c"), (3, changed(prose(7), 60), "d"),  # one group: 3 stays
            (None, other, "a"), (None, other, "b"),  # one group without ids: one stays
            (8, "", "a"), (8, "", "b"), (None, "", "a"), (None, "", "b"), (None, None, "a"), (9, None, "a")]
    got = stage(spark, "minhash near-dedup", rows)
    named = [r for r in got if r[1]]
    assert [r for r in named if r[1] != other] == [(3, changed(prose(7), 60), "d")]
    assert len([r for r in named if r[1] == other]) == 1
    blank = [(i, t) for i, t, _ in got if not t]
    assert sorted(blank, key=str) == sorted([(8, ""), (None, ""), (None, ""), (None, None), (9, None)], key=str)


def test_repeated_rows_and_nulls_pass_every_stage(spark):
    rows = [(i % 4 if i % 5 else None, " ".join(prose(i // 2, 30)) if i % 3 else None, None if i % 2 else "s") for i in range(40)] * 2
    for name, _ in corpus_pipeline.STAGES:
        assert set(stage(spark, name, rows)) <= set(rows)


# ---------------------------------------------------------------- 9
SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyz", "greek": "αβγδεζηθικλμνξοπρστυφχψωςΣ", "thai": "กขคงจฉชดตถทนบปผพฟมยรลวสหอะาิีึืุูเแโใไ่้", "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
           "hindi": "कखगघचछजटठडतथदधनपबमयरलवशसहािीुूेैोौ्", "han": "的一是不了在人有我他这中大来上国", "hangul": "가나다라마\u1100\u1161\u11a8", "marks": "-=!#.,'’“",
           "blank": "a\u3000\xa0\x85\x1cB'é\u0301İ漢1ſŉß",
           "mixed": "aB9é-'sštREveLlmd漢<|>.,!İǅ\u0301\u0323eo😀ßΣσÅK"}


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.VOCABULARY)


@pytest.mark.parametrize("script", SCRIPTS)
def test_every_prefix_is_counted_as_the_library_counts_it(counter, script):
    rng = random.Random(script)
    for i in range(60):
        piece = "".join(rng.choices(SCRIPTS[script], k=rng.randint(1, 40))) + rng.choice(["", "", "<|endoftext|>", "<|endoftext", "<|startoftext|>-"]) + rng.choice(SCRIPTS[script])
        want = [counter._count(piece[:k]) for k in range(1, len(piece) + 1)]
        assert counter.prefix_counts(piece).tolist() == want, piece
        limit = rng.randint(0, 12)
        assert counter.longest_within(piece, limit) == max((k for k, n in enumerate([0, *want]) if n <= limit)), (piece, limit)


@pytest.mark.parametrize("piece", [*(s * (1_000_000 // len(s)) for s in SCRIPTS.values()), "x" * 1_000_000, "İ" * 500_000, "a'" * 500_000, "<|endoftext|>" * 70_000])
def test_unspaced_text_of_a_million_characters(counter, piece):
    start = time.time()
    end = counter.longest_within(piece, 2048)
    assert time.time() - start < 20
    assert counter._count(piece[:end]) <= 2048 < min(counter._count(piece[:k]) for k in range(end + 1, end + 20))


def test_the_table_of_unspaced_texts(spark):
    texts = ["".join(random.Random(s).choices(s, k=30_000)) for s in SCRIPTS.values()]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in tokens.token_prefixes(rows, limits=(100, 2048), keep=False).collect():
        assert [tokens.Counter(tokens.VOCABULARY)._count(texts[r.id][:n]) <= limit for n, limit in zip(r.fits, (100, 2048), strict=True)] == [True, True]
        assert all(0 < n <= 30_000 for n in r.fits)
