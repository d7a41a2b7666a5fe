"""The pipeline's stages on a small table with planted cases, and the registered queries against their SQL."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

import corpus_pipeline
from checks.compare import cells, connect
from keepwell.llm.oracle import ORACLE_SQL
from keepwell.llm.queries import QUERIES
from keepwell.session import scratch_path

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(3000)]

    def prose(n):
        return rng.choices(words, k=n)
    item, passage, base = prose(30), prose(80), prose(200)
    clean = [prose(rng.randint(50, 200)) for _ in range(60)]
    near = [[w if k != 11 + j else "changed" for k, w in enumerate(base)] for j in range(5)]
    shared = [prose(40) + passage + prose(40) for _ in range(4)]
    leaked = [prose(40) + item[5:25] + prose(40)]
    toxic = [["you", "idiot,", "moron"] + prose(50) for _ in range(3)]
    texts = [" ".join(t) for t in (*clean, base, *near, *shared, *leaked, *toxic)] + [None, "", "short text"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    path = scratch_path(spark, "planted")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i >= 71 and i < 74)) for i in range(74)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages(spark, planted):
    path, rows = planted
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        out = scratch_path(spark, "stage")
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name.split()[0]] = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == (COLUMNS if name.split()[0] != "mixing" else [*COLUMNS, "copy_no"])
    clean = set(range(60)) | {74, 75, 76}
    assert set(kept["toxicity"]) == set(range(77)) - {71, 72, 73}
    assert set(kept["minhash"]) == set(kept["toxicity"]) - {61, 62, 63, 64, 65}
    assert set(kept["suffix-array"]) == set(kept["minhash"])
    assert [len((kept["suffix-array"][i].text or "").split()) for i in (66, 67, 68, 69)] == [160, 80, 80, 80]
    assert all(r.n_chars == len(r.text) for r in kept["suffix-array"].values() if r.text)
    assert set(kept["benchmark"]) == set(kept["suffix-array"]) - {70}
    assert all(kept["benchmark"][i].text == rows[i][1] for i in clean)
    assert set(kept["mixing"]) <= set(kept["benchmark"])


def test_run_is_the_stages_and_an_empty_table_stays_empty(spark, planted):
    path, _ = planted
    first = sorted((r.doc_id, r.copy_no) for r in corpus_pipeline.run(spark, path).collect())
    assert first and first == sorted((r.doc_id, r.copy_no) for r in corpus_pipeline.run(spark, path).collect())
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = connect(SMALL)
    got, want = QUERIES[name](spark, SMALL).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and cells(got) == cells(want)


def test_rest_works_without_the_subpackage():
    """The entry module's import guard names the subpackage and the pipeline, and nothing else imports either."""
    top = Path(corpus_pipeline.__file__).parent
    for path in [*top.glob("keepwell/**/*.py"), *top.glob("checks/*.py"), *top.glob("tests/*.py"), top / "bench.py"]:
        if "llm" not in path.parts:
            assert "keepwell.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
