"""Operators against brute force on small tables, and on nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import chat, decontamination, embeddings, html_text, minhash, mixing, suffixes, tokens, toxicity, warc
from keepwell.llm.components import connected_components
from keepwell.session import scratch_path

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, key string"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, "k") for i, t, s in rows], DOCS)


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgéñ", k=rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Prose with exact copies, near copies in chains, shared passages, nulls, empty, short and long texts."""
    rng, words = random.Random(5), vocabulary(1)
    out, base = [], [rng.choices(words, k=rng.randint(30, 160)) for _ in range(12)]
    passage = rng.choices(words, k=70)
    for b in base:
        out.append(" ".join(b))
        for _ in range(5):
            c = list(b)
            for _ in range(rng.randint(0, 5)):
                c[rng.randrange(len(c))] = rng.choice(words)
            out.append((" " if rng.random() < .7 else "\n").join(c))
            b = c if rng.random() < .5 else b
    out += [" ".join(rng.choices(words, k=60) + passage + rng.choices(words, k=40)) for _ in range(4)]
    out += [out[3], out[3].upper(), None, "", " \t\n", "one", "ONE", "one two", "a b c d", " ".join(["For"] * 300), " ".join(["For"] * 300)]
    out.append(" ".join(rng.choices(words, k=30_000)))
    return [(i, t, None if i % 7 == 0 else f"s{i % 3}") for i, t in enumerate(out)]


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ---------------------------------------------------------------- 6 and components
@pytest.mark.parametrize("k", [4, 5])
def test_minhash_equals_brute_force(spark, corpus, k):
    sets = []
    for _, t, _ in corpus:
        w = spaced(t)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()})
    links = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    expect = components(len(sets), links)
    got = {r.id: r for r in minhash.near_duplicates(docs(spark, corpus), words=k).collect()}
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(sets))] == expect
    assert all(r.kept == (r.id == r.component_id) for r in got.values())


def test_minhash_on_edges(spark):
    rows = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (2, "A B C D E F", "s"), (None, "a b c d e f", "s"), (3, None, "s")]
    got = sorted(((r.id, r.component_id, r.kept) for r in minhash.near_duplicates(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (3, 3, True)], key=str)
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_estimate_corrects_for_chance():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        common = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        n = int(2000 * share)
        rest = rng.integers(0, 2**63, 2 * (2000 - n), dtype=np.uint64)
        a, b = np.concatenate([common[:n], rest[:2000 - n]]), np.concatenate([common[:n], rest[2000 - n:]])
        sig, _ = minhash.signatures([a, b])
        lanes = sum(((sig[0, c] >> np.uint64(4 * i)) & np.uint64(15)) == ((sig[1, c] >> np.uint64(4 * i)) & np.uint64(15)) for c in range(6) for i in range(16))
        true = n / (4000 - n)
        assert abs((lanes / 96 - 1 / 16) / (15 / 16) - true) < 0.2


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(10, 40)] + [(9, 7), (9, 9), (None, 3)]
    edges = spark.createDataFrame(chain + star + chain, "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in (7, 9, *range(10, 40))}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- 1
def test_decontamination_equals_brute_force(spark, monkeypatch):
    rng, words = random.Random(3), vocabulary(2, 60)
    items = [(f"i{n}", " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 10, 14, 25])))) for n in range(25)] + [(None, "zz yy"), ("n", None), ("i1", "a-b")]
    texts = []
    for _ in range(40):
        t = rng.choices(words, k=rng.randint(0, 60))
        item = rng.choice(items)[1] or ""
        texts.append(", ".join(t[:20]) + "! " + (item.upper() if rng.random() < .5 else item.replace(" ", "--")) + " " + ".".join(t[20:]))
    rows = [(i, t, "s") for i, t in enumerate([*texts, None, "", "a b"])]

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    expect = {}
    for i, t, _ in rows:
        w, hit, names = split(t), set(), set()
        for name, item in items:
            v = split(item)
            for s in range(max(len(v) - 9, 1) if v and name is not None else 0):
                win = v[s:s + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        names.add(name)
        expect[i] = (len(w), len(hit), sorted(names))
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block in (decontamination.BLOCK_WINDOWS, 7):  # in one block and in many
        monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", block)
        found = decontamination.contamination(docs(spark, rows), bench).collect()
        assert {r.id: (r.n_words, r.n_hit, r["items"]) for r in found} == expect
        assert all(sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_hit for r in found)
    nothing = decontamination.contamination(docs(spark, rows), bench.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(r.n_hit for r in nothing)


# ---------------------------------------------------------------- 2
def test_vectors_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 16))
    v = np.concatenate([base, base[:20] + 0.12 * rng.standard_normal((20, 16)), np.repeat(base[:1], 30, axis=0) + 0.1 * rng.standard_normal((30, 16)), base[5:8] * 3])
    rows = [(i, [float(x) for x in r], 0) for i, r in enumerate(v)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] + [1.0] * 15, 0), (n + 4, [1.0, 2.0], 0), (n + 5, [2.0, 4.0], 1), (n + 6, [], 0)]
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    pairs = [(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.9, 1)))] + [(n + 4, n + 5)]
    degree = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, weight int")
    for block in (embeddings.BLOCK, 8):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        got = {r.id: r for r in embeddings.near_vectors(table, miss=1e-9).collect()}
        assert [got[i].component_id for i in range(len(rows))] == components(len(rows), pairs)
        assert [got[i].n_links for i in range(len(rows))] == degree.tolist()
    assert embeddings.near_vectors(table.limit(0)).count() == 0
    assert embeddings.near_vectors(spark.createDataFrame([(None, [1.0])], "vec_id long, embedding array<float>")).first().kept


# ---------------------------------------------------------------- 3
def test_pages():
    def text(source):
        return html_text.Page(source).article()
    body = "<p>First long paragraph of the article, with a <a href=x>link</a> and <b>bold</b>face.</p><p>Second &amp; last,\n with&nbsp;more text in it.</p>"
    want = "First long paragraph of the article, with a link and boldface. Second & last, with more text in it."
    assert text(f"<html><body><nav><a href=1>Home</a></nav><div class='cookie-notice'>We use cookies</div><article>{body}</article>"
                f"<aside>Also read</aside><section id=comments><p>nice nice nice nice article</p></section><form>Mail<input></form><footer>(c)</footer></body></html>") == want
    assert text(f"<div id=top-menu><ul><li>a<li>b</ul></div><div><div>{body}</div></div><script>if (a < b) '</p>'</script><!-- <p>no</p> -->") == want
    assert text("<p>one<p>two<br>three") == "one two three"
    assert text("") == text("<nav>menu</nav>") == text("<html><head><title>t</title></head></html>") == ""
    assert text("just text & more") == "just text & more"
    long = " ".join(["word"] * 50_000)
    assert text(f"<body><article><h1>Title</h1><p>{long}</article>") == f"Title {long}"
    assert text("<article><p>To.</p><p>Some longer text here to read.</p><p>x < y <unclosed") .startswith("To. Some longer text here to read. x < y")


def test_pages_as_table(spark):
    rows = [(1, "u", "<p>a b</p>", "t"), (1, "u", "<p>a b</p>", "t"), (2, None, None, "t"), (None, "u", "", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.id, r.url, r.text) for r in html_text.main_text(table).collect()), key=str)
    assert got == sorted([(1, "u", "a b"), (1, "u", "a b"), (2, None, ""), (None, "u", "")], key=str)
    assert html_text.main_text(table.limit(0)).count() == 0


# ---------------------------------------------------------------- 4
def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "&lt;&amp;lt;&lb;]", "[assistant]x</s>[user]", "é😀<|im_end|>", "", None, "x" * 100_000]
    rows = [(c, t, ["user", "assistant", "system", None][(c + t) % 4], nasty[(c + t) % 7], "z") for c in range(6) for t in range(c + 1)]
    rows += [(9, 0, "assistant", "tie", "z"), (9, 0, "assistant", "tie", "z"), (9, None, "assistant", "first", "z"), (None, 1, "ro]le[", "no id", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.formatted(chat.turns_of_table(table))
    back = {r.conversation: r for r in chat.read_back(made).collect()}
    expect = {}
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expect.setdefault(c, []).append((r or "", x or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in back.items()} == expect
    assert {c: "".join(r.loss_texts) for c, r in back.items()} == {c: "".join(x for r, x in v if r == "assistant") for c, v in expect.items()}
    for r in made.collect():  # the mask's offsets in the whole text say the same
        for m in r.loss:
            assert r.formatted[m.start:m.start + m.length] == r.formatted[m.start - m.offset:][m.offset:m.offset + m.length]
        assert back[r.conversation].formatted_chars == len(r.formatted)
    assert chat.formatted(chat.turns_of_table(table.limit(0))).count() == 0
    plan = chat.read_back(made)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_layouts_by_fingerprint(spark):
    records = [(1, '{"messages": [{"role": "user", "content": "q"}, {"role": "Assistant", "content": "a"}], "id": 7}'),
               (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'),
               (3, '{"instruction": "q", "input": "more", "output": "a"}'), (4, '{"prompt": "q", "completion": "a", "extra": {"x": 1}}'),
               (5, '{"other": 1}'), (6, "no json"), (7, None), (8, '{"instruction": "q", "output": "a"}')]
    got = {r.conversation: r for r in chat.turns_of_records(spark.createDataFrame(records, "id long, j string"), "id", "j").collect()}
    both = [("user", "q"), ("assistant", "a")]
    assert {c: r.turns and [tuple(t) for t in r.turns] for c, r in got.items()} == {
        1: both, 2: both, 3: [("user", "q"), ("user", "more"), ("assistant", "a")], 4: both, 5: None, 6: None, 7: None, 8: both}
    assert got[4].fingerprint == chat.fingerprint(["prompt", "completion"])
    other = spark.createDataFrame([("t", 1, "bot", "hi")], "thread_id string, position int, author string, body string")
    assert chat.turns_of_table(other).first().text == "hi"
    with pytest.raises(ValueError):
        chat.turns_of_table(spark.range(1))


# ---------------------------------------------------------------- 5
def test_mixing_targets_and_draws(spark, corpus):
    table = docs(spark, corpus)
    got = mixing.mixture(table).collect()
    total = sum(len(spaced(t)) for _, t, _ in corpus)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    order = [*sorted(s for s in by if s is not None), None]
    weight, target, open_ = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}, {}, list(order)
    size = {s: sum(r.size for r in rows) for s, rows in by.items()}
    while open_:  # reshare until none is above
        left = 1.5 * total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * size[s]]
        target |= {s: 2.0 * size[s] for s in above} if above else share
        open_ = [s for s in open_ if s not in above] if above else []
    for s, rows in by.items():
        assert np.isclose(rows[0].target, target[s]) and all(r.source_size == size[s] for r in rows)
        assert all(r.copies in (int(r.rate), int(r.rate) + 1) and r.taken == r.copies * r.size <= 2 * r.size for r in rows)
    again = mixing.mixed_documents(table.repartition(3)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in again} == {r.id: r.copies for r in got if r.copies}
    assert mixing.mixed_documents(table).columns == [*table.columns, "copy_no"]
    assert mixing.mixture(table.limit(0)).count() == mixing.mixed_documents(table.limit(0)).count() == 0


# ---------------------------------------------------------------- 7
def test_passages_equal_brute_force(spark, corpus):
    where, words = {}, {i: spaced(t) for i, t, _ in corpus}
    for i, w in words.items():
        for s in range(len(w) - 49):
            where.setdefault(tuple(w[s:s + 50]), set()).add(i)
    expect = {(i, p) for i, w in words.items() for s in range(len(w) - 49) if len(where[tuple(w[s:s + 50])]) > 1 for p in range(s, s + 50)}
    table = docs(spark, corpus)
    found = suffixes.repeated_passages(table).collect()
    assert {(r.id, p) for r in found for s in r.spans for p in range(s.start, s.end)} == expect
    texts = {i: t for i, t, _ in corpus}
    for r in found:
        for s in r.spans:
            assert spaced(texts[r.id].encode()[s.byte_start:s.byte_end].decode()) == words[r.id][s.start:s.end]
            assert r.id not in s.others and all(o in texts for o in s.others)
    cut = {r.doc_id: r.text for r in suffixes.without_repeats(table).collect()}
    kept = {tuple(w[s:s + 50]) for w in map(spaced, cut.values()) for s in range(len(w) - 49)}
    assert kept >= {w for w, holders in where.items() if len(holders) > 1}  # every repeated passage is still somewhere
    touched = {i for i, _ in expect}
    assert all(cut[i] == t for i, t in texts.items() if i not in touched)
    assert suffixes.without_repeats(table).columns == table.columns
    assert suffixes.repeated_passages(table.limit(0)).count() == suffixes.without_repeats(table.limit(0)).count() == 0


def test_rows_with_one_id_or_none_are_no_repeats(spark):
    text = " ".join(vocabulary(9, 80))
    assert suffixes.repeated_passages(docs(spark, [(1, text, "s"), (1, text, "s"), (None, text, "s")])).count() == 0
    assert suffixes.without_repeats(docs(spark, [(1, text, "s"), (1, text, "s"), (None, text, "s"), (2, text, "s"), (3, None, "s")])).count() == 4


def test_equal_texts_get_the_same_passages_in_groups(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "COPIES", 2)
    whole, alone = vocabulary(21, 120), " ".join(vocabulary(22, 90))
    rows = [(i, " ".join(whole), "s") for i in (8, 3, 5, 9, 4)] + [(2, " ".join(vocabulary(23, 30) + whole[20:80]), "s"), (7, alone, "s")]
    found = {r.id: r.spans for r in suffixes.repeated_passages(docs(spark, rows)).collect()}
    assert {i: [(s.start, s.end) for s in spans] for i, spans in found.items()} == {2: [(30, 90)], **{i: [(0, 120)] for i in (3, 4, 5, 8, 9)}}
    assert all(s.others == ([2, 3] if i != 3 else [2, 9]) for i in (3, 4, 5, 8, 9) for s in found[i]) and found[2][0].others == [9]
    cut = {r.doc_id: r.text for r in suffixes.without_repeats(docs(spark, rows)).collect()}
    assert cut[7] == alone and 2 in cut and 3 in cut


def test_no_passage_is_left_in_two_documents(spark, corpus):
    def holders(texts):
        out = {}
        for i, t in texts.items():
            w = spaced(t)
            for s in range(len(w) - 49):
                out.setdefault(tuple(w[s:s + 50]), set()).add(i)
        return out

    def cut(rows):
        return {r.doc_id: r.text for r in suffixes.without_repeats(docs(spark, rows)).collect()}
    p, x, y, q, r = (vocabulary(s, n) for s, n in ((31, 60), (32, 60), (33, 60), (34, 60), (35, 60)))
    # a shared passage within a longer one that two others share; then with contexts on both sides in every document
    inner = [(1, " ".join(p), "s"), (2, " ".join(x + p + y), "s"), (3, " ".join(x + p + y), "s")]
    crossed = [*((i, " ".join(q + p + r), "s") for i in (1, 2)), *((i, " ".join(x + p + y), "s") for i in (3, 4))]
    for rows in (inner, crossed, corpus):
        texts = {i: t for i, t, _ in rows}
        left = cut(rows)
        assert all(len(ids) == 1 for ids in holders(left).values())
        words = {w for t in left.values() for w in spaced(t)}
        assert words == {w for t in texts.values() for w in spaced(t)}  # no word is lost
    assert {i: len(spaced(t)) for i, t in cut(crossed).items()} == {1: 180, 3: 120}


# ---------------------------------------------------------------- 8
def test_warc_round_trip_and_audit(spark):
    pages = [(i, f"http://x/{i}\r\nbad", f"<p>{'é' * (i % 5)} {i}</p>\r\n\r\n" + ("\r\n\r\nWARC/1.0\r\nfake" if i == 7 else "")) for i in range(300)] + [(300, None, None)]
    table = spark.createDataFrame(pages, "id long, url string, html string").repartition(5)
    records = table.select("id", warc.record(F.col("id"), F.col("url"), F.col("html")).alias("record")).cache()
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc.write_warc(records, first)
    back = {int(r.id): r.payload for r in warc.read_warc(spark, first).collect()}
    assert back == {i: h or "" for i, _, h in pages}
    damaged, lost = {5, 6, 250}, {100}
    warc.write_warc(records.where(~F.col("id").isin(*lost)).withColumn("record", F.when(F.col("id").isin(*damaged), F.regexp_replace("record", "<p>", "<q>")).otherwise(F.col("record"))), second)
    a, b = warc.leaves(spark, first), warc.leaves(spark, second)
    assert a.where("not intact").count() == 0 and {int(r.id) for r in b.where("not intact").collect()} == damaged
    found = {(int(r.id), r.fault) for r in warc.audit(a, b).collect()}
    assert found == {(i, "damaged") for i in damaged} | {(i, "missing") for i in lost}
    assert {(int(r.id), r.fault) for r in warc.audit(b, a).collect()} == {(i, "damaged") for i in damaged} | {(i, "extra") for i in lost}
    assert warc.audit(a, a).count() == 0
    offsets = sorted((r.offset, r.length) for r in a.where("shard = 0").collect())
    assert all(x + n + 4 == y for (x, n), (y, _) in zip(offsets, offsets[1:]))
    records.unpersist()


# ---------------------------------------------------------------- 9
def test_token_prefixes_equal_the_library(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))

    def count(text):
        return len(library.encode(text, add_special_tokens=False).ids)
    odd = ["It's <|endoftext|> x<|startoftext|>y 12345 don't no breaḱ é ́a İstanbul ΑΣ \x1cfile\x85next 😀👍🏽 ﬁ ½", "　", "a\x0bb\x0cc\rd"]
    rows = [*corpus, *((len(corpus) + i, t, "s") for i, t in enumerate(odd))]
    got = {r.id: r for r in tokens.token_prefixes(docs(spark, rows), limits=(100, 2048)).collect()}
    for i, t, _ in rows:
        t = t or ""
        assert (got[i].n_tokens, got[i].n_bytes) == (count(t), len(t.encode()))
        for e, c in list(zip(got[i].ends, got[i].counts))[:40]:
            assert count(t[:e]) == c
        for limit, chars in zip((100, 2048), got[i].fits):
            assert count(t[:chars]) <= limit
    held = tokens.token_prefixes(docs(spark, rows[:6])).select("id", tokens.budget_end(50).alias("end"), tokens.count_within(200).alias("n")).collect()
    for r in held:
        assert count(rows[r.id][1][:r.end]) <= 50 and r.n <= count(rows[r.id][1][:200])
    pieces = tokens.piece_prefixes(docs(spark, rows[-3:])).collect()
    assert all(r.counts == [count(r.piece[:k]) for k in range(1, len(r.piece) + 1)] for r in pieces)


def test_budgets_and_offsets_inside_a_piece(spark):
    counter, rng = tokens.Counter(tokens.VOCABULARY), random.Random(41)

    def count(text):
        return len(counter.library.encode(text, add_special_tokens=False).ids)
    odd = "It's!!<|endoftext|>x12é\u0301İ!don't...a\u0301=\u0338b\u3000cΣ1"
    mixed = ["".join(rng.choices("abcXYZ019'!?.<|>éÉ漢字、。İ\u0301", k=rng.randint(1, 300))) for _ in range(30)]
    texts = [odd, " ".join(["one", odd, "two"]), "漢字仮名交文" * 900, "".join(rng.choices("abcdefgh019+/", k=9000)), "x" * 5000, *mixed, None]
    limits, offsets = (0, 3, 20, 2048), (0, 2, 7, 40, 4000)
    got = {r.id: r for r in tokens.token_prefixes(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), limits=limits, keep=False, offsets=offsets).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        assert got[i].within == [count(t[:n]) for n in offsets]
        if len(t) < 1000:
            counts = [count(t[:n]) for n in range(len(t) + 1)]
            for limit, chars in zip(limits, got[i].fits):
                assert chars == max(n for n, c in enumerate(counts) if c <= limit), (t, limit)
    long = texts[2]
    assert count(long) > 2048 >= count(long[:got[2].fits[3]]) and 0 < got[2].fits[3] < len(long)
    assert all(count(long[:n]) > 2048 for n in range(got[2].fits[3] + 1, got[2].fits[3] + 60))


# ---------------------------------------------------------------- 10
def test_clause_grammar():
    def worth(*kinds):
        return toxicity.run_clause([(k, k, 4.0) for k in kinds]).get("insult", 0.0)
    assert worth("target", "insult") > worth("insult") > worth("report", "insult") > 0
    assert worth("insult") > worth("negation", "other", "insult") > 0
    assert worth("negation", "other", "other", "other", "insult") == worth("insult")
    assert toxicity.run_clause([("threat", "kill", 3.0), ("other", "x", 0.0)]) == {}
    assert toxicity.run_clause([("threat", "kill", 3.0), ("target", "you", 0.0)]) == {"kill": 3.0}


def test_toxicity_is_learned_from_text(spark):
    rng, words = random.Random(8), vocabulary(3, 300)
    rows, labels = [], []
    for i in range(600):
        w, toxic = rng.choices(words, k=rng.randint(20, 120)), int(i % 5 == 0)
        for _ in range(3 if toxic else 0):
            w[rng.randrange(len(w))] = "zorgh" + rng.choice(["a", "en", "ly", "ed"])
        rows.append((i, " ".join(w) + ".", "s"))
        labels.append((i, toxic, 1))
    labels += [(0, 1, 1), (9999, 1, 1), (None, 1, 1), (5, None, 1)]
    table, marks = docs(spark, rows + [(700, None, "s"), (701, "", "s"), (None, "x", "s")]), spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    rows_used = toxicity.training_rows(table, marks)
    assert rows_used.count() == sum(1 for i in range(600) if zlib.crc32(str(i).encode()) % 5)
    model = toxicity.train(rows_used)
    assert any(e.startswith("zorgh") for e in model.insults)
    scored = toxicity.with_score(table, model).collect()
    assert len(scored) == 603 and all(0 <= r.score <= 1 for r in scored)
    assert all((r.score >= 0.5) == (r.doc_id % 5 == 0) for r in scored if r.doc_id is not None and r.doc_id < 600)
    assert {r.score for r in scored if r.doc_id in (700, 701)} == {toxicity.Scorer(model).score("")}
    alone = toxicity.train(toxicity.training_rows(table, marks.limit(0)))
    assert toxicity.Scorer(alone).score("you are an idiot and a moron") > 0.5 > toxicity.Scorer(alone).score("a fine day")
    assert toxicity.with_score(table.limit(0), model).count() == 0
