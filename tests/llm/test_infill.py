"""Fill-in-middle against a plain reading of the rules, on odd texts, and back again."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from keepwell.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, n int, form string, output string, h1 int, a int, b int"


def plainly(key, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    rng = random.Random(3)
    pieces = ["a", "word", " ", "  ", "\n", "\t", "\x0b", "\xa0", "é", "😀", "漢字", "<P", "<S", "<M", ">", "$1", "\\", "\\$2", "{3}", "\x00", " ", "\x85"]
    fixed = ["", None, " ", " \n ", "a", " a", "a ", "x <P> y", "<S>", "a<M>", "<P", "<<S", "$0 \\1"]
    return fixed * 6 + ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(500)]


@pytest.fixture(scope="module")
def cut(spark):
    rows = [*enumerate(odd_texts()), (None, "a b c d"), (None, None), (7, "one two three four"), (7, "one two three four")]
    given = spark.createDataFrame([(i, t, "x", 1, "f", "o", 2, 3, 4) for i, t in rows], SCHEMA)
    found = infill.filled_in_middle(given).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    return rows, found.collect()


def test_every_column_equals_the_plain_reading(cut):
    rows, got = cut
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    expect = sorted(((i, *plainly(i, t)) for i, t in rows), key=key)
    found = sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key)
    assert found == expect
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_the_text_comes_back_from_output_and_form(cut):
    rows, got = cut
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)


@pytest.mark.parametrize("text", ["w " * 400_000, " " * 1_000_000, "z" * 1_000_000, "ab\n\t " * 200_000])
def test_very_long_texts_neither_overflow_the_stack_nor_stall(spark, text):
    found = infill.filled_in_middle(spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string"))
    got = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == text and (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.id, text) for r in got)
    assert {r.form for r in got} >= {"plain", "spm"}


def test_percentages_and_seed_are_parameters(spark):
    given = spark.createDataFrame([(i, "one two three") for i in range(200)], "key long, body string")
    forms = lambda **how: {r.form for r in infill.filled_in_middle(given, "key", "body", **how).collect()}
    assert forms(percent=0) == {"plain"}
    assert forms(percent=100, percent_spm=0) == {"psm"}
    assert forms(percent=100, percent_spm=100) == {"spm"}
    output = lambda seed: [r.output for r in infill.filled_in_middle(given, "key", "body", seed).orderBy("id").collect()]
    assert output(1) == output(1) != output(2)


def test_empty_table_gives_an_empty_table(spark):
    found = infill.filled_in_middle(spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == []
    assert found.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_the_plan_has_no_python_and_no_exchange(spark):
    found = infill.filled_in_middle(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
