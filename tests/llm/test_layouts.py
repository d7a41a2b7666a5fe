"""Records with more fields than their mapping, and pages with extreme markup."""

import json
import time

from keepwell.llm import chat, html_text


def test_further_fields_never_hide_a_layout(spark):
    q, a = ("user", "q"), ("assistant", "a")
    listed = [{"role": "user", "content": "q", "name": "x"}, {"role": "assistant", "content": "a", "weight": 1}]
    cases = [({"prompt": "q", "response": "a", "input": "i"}, [q, a]),
             ({"prompt": "q", "completion": "a", "system": "s"}, [("system", "s"), q, a]),
             ({"messages": listed, "prompt": "p"}, [q, a]),
             ({"messages": listed, "prompt": "p", "response": "r"}, [q, a]),  # as many paths: the first mapping of the list
             ({"messages": [{"role": "user", "content": None}, *listed]}, [("user", ""), q, a]),
             ({"messages": [{"role": "user"}, {"content": "a"}]}, [("user", ""), ("", "a")]),
             ({"messages": [], "question": "q", "answer": "a"}, [q, a]),
             ({"messages": ["q", "a"]}, None),
             ({"messages": "q"}, None),
             ({"messages": []}, None),
             ({"instruction": "q", "input": None, "output": "a"}, [q, a]),
             ({"conversations": [{"from": "Human ", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"}, [q, a])]
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(cases)]
    table = spark.createDataFrame([*rows, rows[0], (None, rows[0][1])], "shape long, turns string")  # names clash with the result's
    found = chat.turns_of_records(table, "shape", "turns")
    got = [(r.conversation, r.turns and [tuple(t) for t in r.turns]) for r in found.collect()]
    expected = [(i, turns) for i, (_, turns) in enumerate(cases)]
    assert sorted(map(str, got)) == sorted(map(str, [*expected, expected[0], (None, expected[0][1])]))
    shapes = {r.conversation: r.shape for r in found.collect()}
    assert shapes[2] != shapes[3] and shapes[0] == shapes[None]
    assert chat.turns_of_records(table.limit(0), "shape", "turns").count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_extreme_markup_is_read_in_linear_time():
    pages = ["<div>" + "</b>" * 100_000 + "text</div>", "<div><p>" + "<b>" * 50_000 + "<hr>" * 50_000 + "text</div>",
             "<b><div>" * 40_000 + "text", "<header>" * 20_000 + "</header>" * 20_000 + "<p>text</p>"]
    begun = time.monotonic()
    assert [html_text.Page(x).article() for x in pages] == ["text"] * 4
    assert time.monotonic() - begun < 30


def test_headings_and_formulas_of_an_article_stay():
    words = "Some words of an article that goes on for a while, as articles do. " * 4
    page = (f'<html><body><nav><a href="/">Home</a></nav><article><h1 class="header">A title</h1><p>{words}</p>'
            f'<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold. {words}</p></article><footer>Imprint</footer></body></html>')
    assert html_text.Page(page).article() == " ".join(f"A title {words} Let x=1 hold. {words}".split())
