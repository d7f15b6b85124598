import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from claimlake.llm import (binary_out, common, components, decontam, embed_dedup, html_extract, jaccard_join, labelled, license_scan, mixing, quality,
                           queries, token_counts, toxicity)

TOK = queries.tokenizer_path()


@pytest.fixture(scope="module")
def docs(spark):
    df = cases.edge_docs(spark)
    df.cache().count()
    return df


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOK)


# 1
def test_html_extraction(spark):
    page = ("<!DOCTYPE html><html><head><title>t</title><script>var a='<p>no</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href='/a'>menu</a></li></ul></nav>"
            "<!-- hidden --><div class='ad'>Buy now please</div><article><h1>Title &amp; more</h1><p><b>First  block<br>goes &lt;on&gt;<p>Second\n\tblock&nbsp;here</p><aside>side box</aside>"
            "<p>Third one, a < b.</p><form>field<input></form><div id='comments'><p>reader says</p></div></article><div class='sidebar'>more</div><footer>&copy; foot</footer></body></html>")
    want = "Title & more\n\nFirst block goes <on>\n\nSecond block here\n\nThird one, a < b."
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<html><body></body></html>"), (4, "u", "plain words"), (1, "u", page), (5, "u", "<p>open <b a='x"), (6, "u", "<article><p>" + "w " * 50_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit("clash"), "n_chars": F.lit("clash")})
    got = [r.asDict() for r in html_extract.main_text(df, html_extract.learn(df)).collect()]
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and by[1]["text"] == want and by[1]["n_chars"] == len(want)
    assert [by[k]["text"] for k in (2, 3, None, 4)] == ["", "", "", "plain words"] and by[6]["n_chars"] == 99_999 and by[5]["text"].startswith("open")
    assert html_extract.main_text(df.limit(0), html_extract.learn(df.limit(0))).count() == 0


def test_html_best_run_is_the_maximum():
    weight = html_extract.weights({})
    page = "<div>a b</div><div><p>one two three four five six seven eight</p></div><li>x</li><li>y</li><p>nine ten</p>"
    assert "one two three" in html_extract.extract(page, weight)


def test_html_whole_table_matches_brute_force(spark, sf_dir):
    import re
    from html import unescape
    got = {r.page_id: r.text for r in queries.op1_html_extract(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", body)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_html_keeps_articles_in_marked_wrappers_and_after_open_elements():
    weight = html_extract.weights({})
    body = "real words of the article " * 20
    want = body.strip()
    article = f"<article><p>{body}</p></article>"
    for wrapper in ("page has-sidebar", "col no-sidebar", "layout--with-sidebar", "page sidebar", "widget"):
        assert html_extract.extract(f"<body><div class='ad'>Buy</div><div class='{wrapper}'><div>{article}</div><div class='sidebar'>side box</div></div></body>", weight) == want
    assert html_extract.extract(f"<body><form id='aspnet'>{article}</form></body>", weight) == want
    assert html_extract.extract(f"<body><div class='col no-sidebar'><p>{body}</p></div></body>", weight) == want
    for inner in (f"<p class='notice'>Ad<p>{body}", f"<div><p class='notice'>Ad</div><p>{body}</p>", f"<ul><li class='share'>Ad<ul><li>Ad</ul><li>{body}</ul>", f"<ul><li class='share'>Ad</ul><p>{body}",
                  f"<dl><dt class='ad'>Ad<dd>{body}</dl>", f"<table><tr class='ad'><td>Ad<tr><td>{body}</table>", f"<table><tr><td class='ad'>Ad<table><tr><td>Ad</table><td>{body}</table>",
                  f"<p class='notice'>Ad <b>Ad</b> Ad</p><p>{body}</p>"):
        assert html_extract.extract(f"<body><article>{inner}</article></body>", weight) == want
    assert html_extract.extract(f"<body>{article}<div class='comments'><article class='comment'><p>{'said a reader ' * 60}</p></article></div></body>", weight) == want
    assert html_extract.extract("<div class='ad'>" * 20_000 + article, weight) == want


def test_html_keeps_all_of_the_article():
    weight = html_extract.weights({})
    body = " ".join(f"word{i}" for i in range(60))
    page = lambda inner: f"<html><body><nav><a href=x>menu</a></nav>{inner}<footer>foot</footer></body></html>"
    get = lambda inner: html_extract.extract(page(inner), weight)
    p = f"<p>{body}</p>"
    for inner, more in ((f"{p}<div class='ad'>Buy</div><p>The end</p>", "\n\nThe end"), (f"{p}<ul><li>main1</li><li>main2</li></ul>", "\n\nmain1\n\nmain2"),
                        (f"{p}<p><a href=y>All of it here</a></p>", "\n\nAll of it here"), (f"{p}<div><div><div>Fin</div></div></div>", "\n\nFin"),
                        (f"{p}<p class='social-studies'>On schools</p>", "\n\nOn schools"), (f"{p}<div class='search-theory'>On search</div>", "\n\nOn search"),
                        (f"{p}<div id='advertisement-free'>Quiet</div>", "\n\nQuiet"), (f"{p}<table><tr><td>a<td>b<tr><td>c</table>", "\n\na b\n\nc"),
                        (f"{p}<div class='share-box'>Share</div><p class='post-comments'>Reader</p>", "")):
        for border in ("article", "main"):
            assert get(f"<{border}>{inner}</{border}>") == body + more, inner
        assert get(f"<div class='content'>{inner}</div>") == body + more, inner
    assert get(f"<article><h1>Title</h1><div class=share>Share it</div>{p}</article>") == f"Title\n\n{body}"
    assert get(f"<div id=story><h1>Title</h1><div class=share>Share it</div>{p}</div>") == f"Title\n\n{body}"
    assert get(f"<main><article>{p}</article><article><p>Second one</p></article></main>") == f"{body}\n\nSecond one"
    assert get(f"<main><p>{' '.join(['main'] * 30)}</p></main><div><p>{' '.join(['aside'] * 100)}</p></div>") == " ".join(["main"] * 30)


def test_html_drops_readers_comments_marked_up_as_articles():
    weight = html_extract.weights({})
    body, said = " ".join(f"word{i}" for i in range(60)), "said a reader " * 40
    one = f"<article class=comment><p>{said}</p></article>"
    for page in (f"<article><p>{body}</p><section class=comments>{one}{one}</section></article>", f"<main><article><p>{body}</p></article>{one}{one}</main>",
                 f"<article><p>{body}</p><section id=comments><article><p>{said}</p></article><article><p>{said}</p></article></section></article>",
                 f"<article><p>{body}</p></article><section id=comments><article><p>{said}</p></article></section>",
                 f"<main><p>{body}</p><div class='post-comments'><article><p>{said}</p><article><p>{said}</p></article></article></div></main>"):
        assert html_extract.extract(f"<html><body>{page}</body></html>", weight) == body, page
    assert html_extract.extract(f"<body><article class='promo'><p>{body}</p></article></body>", weight) == body  # the only article there is


# 2
def test_decontamination_by_brute_force(spark):
    rng = random.Random(5)
    items = [(i, cases.words(rng, 18 + i)) for i in range(6)] + [(90, None), (91, "too short"), (None, cases.words(rng, 20))]
    rows = cases.edge_rows()
    n = 500
    for i, t in items[:6]:
        for edits in (0, 2, 5, 8, 11, 14, 30):
            s = list(t)
            for _ in range(edits):
                s[rng.randrange(len(s))] = "z"
            rows.append((n, cases.words(rng, 30) + " " + "".join(s) + " " + cases.words(rng, 10), "en", "s1", 1))
            n += 1
    df = spark.createDataFrame(rows, cases.SCHEMA).withColumn("leaks", F.lit("clash")).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    text = lambda t: "".join(map(chr, decontam.normal(t or "")))
    norm = [(i, text(t)) for i, t in items if t and len(text(t)) >= decontam.MIN_CHARS]
    got = decontam.find_items(df, bench).collect()
    assert len(got) == len(rows)
    for r in got:
        t = text(r.text)
        if r.doc_id is not None and r.doc_id >= 500:
            want = {}
            for i, s in norm:
                k, d = min(int(len(s) * decontam.EDITS), (len(s) - decontam.Q) // decontam.Q), cases.edit_distance_inside(s, t)
                if d <= k:
                    want[i] = d
            assert {x.item_id: x.edits for x in r.leaks} == want
        else:
            assert not r.leaks
    assert decontam.decontaminate(df, bench).columns == df.columns
    assert decontam.decontaminate(df, bench.limit(0)).count() == len(rows)
    assert decontam.find_items(cases.empty_docs(spark), bench).count() == 0


def test_decontamination_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    rng = random.Random(9)
    items = [(i, cases.words(rng, 20)) for i in range(5)]
    df = spark.createDataFrame([(1, items[0][1] + " and " + items[4][1]), (2, None), (3, items[2][1])], "doc_id bigint, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in decontam.find_items(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {1: [0, 4], 2: [], 3: [2]}


def test_decontamination_of_short_items(spark):
    items = [(1, "Who wrote Faust?"), (2, "今日の東京の天気はどうですか"), (3, "2 + 2"), (4, "天気"), (5, "cat"), (6, "?!"), (7, "Cat."), (8, "What is the capital of France?"), (None, "x"), (9, "天a")]
    rows = [(1, "so: who wrote  FAUST, and when"), (2, "質問:今日の東京の天気はどうですか、と"), (3, "is 2+2 four"), (4, "a cat, a concatenation"), (5, "concatenation 12 2 2a"), (6, None), (7, "x"), (8, "?!"),
            (9, "what is the capitol of France"), (10, "it is cat"), (11, "天ab"), (12, "Ｘ天a b")]
    want = {1: [1], 2: [2, 4], 3: [3], 4: [5, 7], 5: [], 6: [], 7: [None], 8: [], 9: [8], 10: [5, 7], 11: [], 12: [9]}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: {x.item_id: x.edits for x in r.leaks} for r in decontam.find_items(docs, bench).collect()}
    assert {k: sorted(v, key=lambda i: i or 0) for k, v in got.items()} == want and got[9] == {8: 1}
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, bench).collect()) == [k for k, v in want.items() if not v]


def test_decontamination_whole_table(spark, sf_dir):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    whole = {r.doc_id: {i for i, t in bench if t in r.text} for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op2_decontaminate(spark, sf_dir).collect():
        assert whole[r.doc_id] <= set(r.item_ids) and (r.contaminated == bool(r.item_ids)) and (whole[r.doc_id] or not r.contaminated or r.edits is not None)


# 3
def test_mixing(spark, docs):
    sized = docs.drop("size").withColumn("size", mixing.word_count())
    got = mixing.mix(sized).collect()
    rows = cases.edge_rows()
    assert len(got) == len(rows)
    total = sum(r.size for r in got)
    by = {}
    for r in got:
        s = by.setdefault(r.source, [r.source_size, r.target, 0, 0, 0])
        s[2] += r.size
        s[3] += r.size * r.copies
        s[4] = max(s[4], r.size)
        assert 0 <= r.copies <= 2
    for size, target, words, taken, longest in by.values():
        assert size == words and target <= 2 * size + 1e-6 and abs(taken - target) <= 2 * longest + 1
    assert math.isclose(sum(s[1] for s in by.values()), 1.5 * total, rel_tol=1e-9)
    again = Counter(tuple(r) for r in mixing.mix(sized.repartition(5)).select("doc_id", "size", "source", "copies").collect())
    assert again == Counter((r.doc_id, r.size, r.source, r.copies) for r in got)
    assert mixing.emit(mixing.mix(sized)).count() == sum(r.copies for r in got)
    assert mixing.mix(cases.empty_docs(spark).withColumn("size", mixing.word_count())).count() == 0


def test_mixing_targets_by_repeated_sharing(spark):
    sizes = [("a", 1), ("b", 100), ("c", 5), ("d", 0), (None, 40), ("Z", 7)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()}
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(order)}
    cap, left, open_ = {s: 2.0 * n for s, n in sizes}, 1.5 * sum(n for _, n in sizes), {s for s, _ in sizes}
    want = {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > cap[s]}
        if not over:
            want |= {s: weight[s] * level for s in open_}
            break
        want |= {s: cap[s] for s in over}
        left -= sum(cap[s] for s in over)
        open_ -= over
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


# 4
def test_toxicity(spark, docs):
    rng = random.Random(1)
    train = [(1000 + i, cases.words(rng, 40) + (" vile brute" * (1 + i % 4) if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(None, 1), (1, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r for r in toxicity.grade(df, model).collect()}
    assert all((got[i].p_toxic >= 0.5) == bool(y) for i, _, y in train) and model["theta"][0] < model["theta"][1]
    few, many = [got[i].severity for i, t, y in train if y and t.count("vile") == 1], [got[i].severity for i, t, y in train if t.count("vile") == 4]
    assert np.mean(many) > np.mean(few) and all(0 <= r.severity <= 2 for r in got.values())
    edge = toxicity.grade(docs, model).collect()
    assert len(edge) == len(cases.edge_rows()) and all(math.isfinite(r.severity) for r in edge)
    none = toxicity.fit(cases.empty_docs(spark), labels.limit(0))
    assert not any(r.p_toxic >= 0.5 for r in toxicity.grade(docs, none).collect()) and toxicity.grade(cases.empty_docs(spark), model).count() == 0


def test_ordinal_gradient_fits_ordered_grades():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = np.digitize(x @ np.array([2.0, -1.0, 0.0]) + 0.2 * rng.normal(size=600), [-0.5, 1.0])
    w, theta = toxicity.fit_ordinal(x, y)
    assert w[0] > 0 > w[1] and theta[0] < theta[1]
    p = toxicity.cumulative(w, theta, x)
    assert np.mean((p > 0.5).sum(1) == y) > 0.9


def test_toxicity_held_out(spark, sf_dir):
    got = {r.doc_id: r.toxic for r in queries.op4_toxicity(spark, "/root/testdata/sf0.01").collect()}
    marks = {"moron", "idiot", "clown", "scum", "trash", "stupid", "loser", "pathetic", "worthless", "disgusting"}
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'").collect()}
    bad = [i for i, t in docs.items() if len(marks & set(t.lower().split())) >= 3]
    clean = [i for i, t in docs.items() if not any(m in t.lower() for m in marks)]
    assert sum(got[i] for i in bad) >= 0.9 * len(bad) and sum(got[i] for i in clean) <= 0.05 * len(clean)


# 5
def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 16))
    parts = [base]
    for c in (0.99, 0.96, 0.94, 0.9):
        b = base[:150] / np.linalg.norm(base[:150], axis=1, keepdims=True)
        t = rng.normal(size=b.shape)
        t -= (t * b).sum(1)[:, None] * b
        parts.append(3 * (c * b + math.sqrt(1 - c * c) * t / np.linalg.norm(t, axis=1, keepdims=True)))
    x = np.concatenate([*parts, np.repeat(base[:1], 1500, 0)])
    label = [int(i % 7 == 6) if i < 400 else 0 for i in range(len(x))]
    odd = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [1.0, None] * 8, 0), (9004, x[0].tolist(), None), (9005, [1.0, 2.0], 0), (9006, [2.0, 4.0], 0), (9007, [], 0),
           (None, x[0].tolist(), 0), (9008, [float("inf")] + [0.0] * 15, 0)]
    df = spark.createDataFrame([(int(i), v.tolist(), l) for i, (v, l) in enumerate(zip(x, label))] + odd, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df.withColumn("cls", F.lit("clash")).repartition(4)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    want = near.sum(1) + near[:, 0] + np.array([i == 0 or (x[i] == x[0]).all() for i in range(len(x))]) * 1 - near[:, 0] + (near[:, 0] & ~(x == x[0]).all(1))
    n = np.array([got[i].n_links for i in range(len(x))])
    assert (n <= want).all() and n.sum() >= 0.98 * want.sum()
    assert got[0].n_links >= 1501 and got[0].kept and got[1700].component_id == 0 and not got[1700].kept
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (9000, 9001, 9002, 9003, 9004, 9007, 9008))
    assert got[9006].component_id == 9005 and got[9005].n_links == 1 and got[None].component_id == 0
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_count_on_both_sides(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(size=(600, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    t = rng.normal(size=a.shape)
    t -= (t * a).sum(1)[:, None] * a
    x = np.concatenate([a, 0.935 * a + math.sqrt(1 - 0.935 ** 2) * t / np.linalg.norm(t, axis=1, keepdims=True)])
    assert ((x @ x.T >= 0.93).sum(1) == 2).all()  # each has one partner
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, recall=0.75).collect()}  # a short walk: many links are found from one side only
    linked = [i for i in range(600) if got[600 + i].component_id == i]
    assert 100 < len(linked) and all(got[i].n_links == got[600 + i].n_links == int(got[600 + i].component_id == i) for i in range(600))


def test_multi_sequence_walk_is_in_order():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    got = embed_dedup.walk(a, b, 0.6)
    every = sorted((a[i] + b[j], i, j) for i in range(9) for j in range(7))
    assert [(i, j) for s, i, j in every if s <= every[0][0] + 0.6] == got


# 6
def brute(rows):
    sets = [cases.shingle_set(r[1]) for r in rows]
    comp = cases.brute_components(sets)
    least = {}
    for r, s, c in zip(rows, sets, comp):
        if s and r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return Counter((r[0], len(s), least.get(c) if s else r[0]) for r, s, c in zip(rows, sets, comp))


def test_jaccard_edges(spark, docs):
    got = Counter(tuple(r) for r in jaccard_join.join(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(cases.edge_rows())
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    worded = [r for r in rows if cases.shingle_set(r[1])]
    assert len(worded) == len({c for r, c in zip(cases.edge_rows(), cases.brute_components([cases.shingle_set(r[1]) for r in cases.edge_rows()])) if cases.shingle_set(r[1])})
    assert len(rows) - len(worded) == 3
    assert jaccard_join.join(cases.empty_docs(spark)).count() == 0 and jaccard_join.one_of_each(cases.empty_docs(spark)).count() == 0


@pytest.mark.parametrize("leaf", [8, 2])
def test_jaccard_families_and_shared_passages(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    rng = random.Random(7)
    rows, i = [], 0
    for family, edits in ((30, 2), (25, 9), (12, 16), (3, 5)):
        base = cases.words(rng, 100).split()
        for _ in range(family):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = cases.words(rng, 1)
            rows.append((i, " ".join(w)))
            i += 1
    passage = cases.words(rng, 60)
    for k in range(40):  # documents that are mostly the passage, with tails of many lengths
        rows.append((i, passage + " " + cases.words(rng, 5 + k)))
        i += 1
    got = Counter(tuple(r) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)


def test_jaccard_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in queries.op6_jaccard_join(spark, sf_dir).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (-3, 150)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: -3, 150: -3, -3: -3}


# 7
def test_quality(spark, docs):
    rng = random.Random(2)
    train = [(1000 + i, cases.words(rng, 50) if i % 4 else " ".join(w + "%%%" for w in cases.words(rng, 50).split()), int(bool(i % 4))) for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(None, 1), (1, None)], "doc_id bigint, quality int")
    model = quality.fit(df, labels)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert all((got[i] >= quality.CUT) == bool(y) for i, _, y in train)
    edge = quality.score(docs, model)
    assert edge.columns == [c for c in docs.columns if c != "score"] + ["score"]
    edge = edge.collect()
    assert len(edge) == len(cases.edge_rows()) and all(0 <= r.score <= 1 for r in edge)
    same = {}
    for r in edge:
        assert same.setdefault(r.text or "", r.score) == r.score
    assert quality.keep_good(docs, labels).columns == docs.columns
    none = quality.fit(cases.empty_docs(spark), labels.limit(0))
    assert quality.score(cases.empty_docs(spark), none).count() == 0 and all(r.score >= 0.3 for r in quality.score(docs, none).collect())


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op7_quality(spark, sf).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    good, bad = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.95 and np.mean([y == p for _, y, p in held]) > 0.93


def test_sample_is_bounded_and_not_held_out(spark):
    df = spark.createDataFrame([(i, "t") for i in range(100)] + [(5, "u")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(5, 1), (None, 1)], "doc_id bigint, quality int")
    got = labelled.sample(df, labels, "quality", 30).collect()
    assert len(got) == 30 and not any(labelled.is_held_out(r.doc_id) for r in got)


# 8
def test_license_scan(spark, docs):
    texts = [(0, "x MIT license cc BY\nmore CC-BY cc by cc by"), (1, None), (2, ""), (3, "GNU General Public\nLicense v3"), (4, "summit license"),
             (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"), (0, "Apache License"), (None, "mit license"),
             (6, "licensed under cc by nc 4 0 " * 3)]
    got = license_scan.scan(spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("labels", F.lit("clash"))).collect()
    by = {(r.doc_id, r.n_words): r for r in got}
    r = by[0, 12]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (5, 1, 10, "cc-by,mit")
    assert (by[3, 5].n_base, by[3, 5].first_word, by[3, 5].last_word) == (1, 0, 0) and by[4, 2].n_base == 0 and by[4, 2].first_word is None
    assert by[5, 18].labels == "mit-notice" and by[5, 18].base_labels == "" and 0.8 <= by[5, 18].score <= 1
    assert by[0, 2].base_labels == "apache" and by[None, 2].n_base == 1 and by[1, 0].score == 0
    assert "cc-by-nc-4.0" in by[6, 21].labels.split(",")
    assert license_scan.scan(docs).count() == len(cases.edge_rows()) and license_scan.scan(cases.empty_docs(spark)).count() == 0


def test_license_scan_of_wrapped_notices(spark):
    def wrapped(t, n, lead=""):
        w = t.split()
        return "\n".join(lead + " ".join(w[i:i + n]) for i in range(0, len(w), n))
    rng = random.Random(8)
    rows, want = [], {}
    for i, (label, t) in enumerate((x, t) for x, texts in license_scan.TEMPLATES.items() for t in texts):
        for j, text in enumerate((wrapped(t, 4), cases.words(rng, 50) + "\n" + wrapped(t, 7, " * ") + "\n" + cases.words(rng, 50), wrapped(t, 1, "// "))):
            rows.append((10 * i + j, text))
            want[10 * i + j] = label
    words = sorted({w for texts in license_scan.TEMPLATES.values() for t in texts for w in t.split()})
    # template words in random order are no notice, nor is one whose words lie too far apart
    rows += [(1000 + i, "\n".join(rng.choice(words) for _ in range(40))) for i in range(40)]
    rows.append((2000, "\n".join(w + " " + cases.words(rng, 3) for w in license_scan.TEMPLATES["bsd"][0].split())))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, label in want.items():
        assert label in got[i].labels.split(",") and got[i].score == 1
    for i, text in rows:
        w, best = "".join(c if c.isalnum() else " " for c in text.lower()).split(), {}
        for label, texts in license_scan.TEMPLATES.items():
            for t in texts:
                s, n = set(t.split()), len(t.split())
                blocks = [w[p:p + n] for p in range(len(w))] + [line.lower().split() for line in text.split("\n")]
                m = max(len(s & set(b)) for b in blocks)
                if m >= license_scan.THRESHOLD * len(s) - 1e-9:
                    best[label] = max(best.get(label, 0), m / len(s))
        base = set(filter(None, got[i].base_labels.split(",")))
        assert set(filter(None, got[i].labels.split(","))) == base | set(best) and (base or got[i].score == max(best.values(), default=0))
    places = {r.place for r in license_scan.similar_windows(df.filter("doc_id = 0")).filter("label = 'gpl-3.0'").collect()}
    assert places <= set(range(12)) and places


# 9
def test_records_round_trip(spark, docs, library, tmp_path):
    path = f"file://{tmp_path}/records"
    binary_out.write_records(docs, path, TOK)
    index = binary_out.with_start(binary_out.read_index(spark, path))
    got = sorted(binary_out.read_records(index, path).collect(), key=lambda r: r.start)
    rows = sorted(cases.edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    start, ids_of = 0, Counter()
    for r in got:
        assert r.start == start
        start += r.n_tokens
        ids_of[r.doc_id, bytes(r.ids)] += 1
    assert ids_of == Counter((i, np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t, *_ in rows)
    shuffled = binary_out.read_records(index.orderBy(F.rand(3)), path).collect()
    assert Counter(bytes(r.ids) for r in shuffled) == Counter(bytes(r.ids) for r in got)
    binary_out.write_records(docs, path, TOK)  # a second run replaces the same files
    assert binary_out.read_records(binary_out.read_index(spark, path), path).count() == len(rows)


def test_records_go_through_batches_of_bounded_bytes(spark, tmp_path, monkeypatch):
    most, seen, write = 1 << 16, tmp_path / "seen", binary_out._write
    seen.mkdir()

    def watched(*args):
        run = write(*args)

        def noted(batches):
            for b in batches:
                with open(f"{seen}/{b.column(0)[0].as_py()}", "w") as f:
                    f.write(str(b.nbytes))
                yield b
        return lambda batches: run(noted(batches))
    monkeypatch.setattr(binary_out, "BATCH_BYTES", most)
    monkeypatch.setattr(binary_out, "_write", watched)
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 700, F.expr("repeat('long text ', 20000)"))
                                             .otherwise(F.expr("concat(id, repeat(' some words', 40))")).alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, path = spark.conf.get(key), str(tmp_path / "records")
    binary_out.write_records(docs, path, TOK)
    assert spark.conf.get(key) == before
    sizes = sorted(int(x.read_text()) for x in seen.iterdir())
    assert len(sizes) > 10 and sizes[-2] < 2 * most < sizes[-1]  # the long text is over the bound by itself
    rows = binary_out.read_index(spark, path).orderBy("doc_id").toArrow().combine_chunks().to_batches()
    got = [b for b in binary_out._read(path)(iter(rows))]
    assert len(got) > 10 and all(b.num_rows == 1 or sum(map(len, b.column("ids").to_pylist())) <= most for b in got)
    assert [i for b in got for i in b.column("doc_id").to_pylist()] == list(range(2000))
    assert [len(x) // 4 for b in got for x in b.column("ids").to_pylist()] == [n for b in rows for n in b.column("n_tokens").to_pylist()]


def test_records_of_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    binary_out.write_records(cases.empty_docs(spark), path, TOK)
    assert binary_out.read_index(spark, path).count() == 0


def test_frames_find_damage():
    f = binary_out.frame(b"payload")
    assert binary_out.unframe(f) == b"payload" and len(f) == 7 + binary_out.HEAD + binary_out.TAIL
    for i in range(len(f)):
        with pytest.raises(ValueError):
            binary_out.unframe(f[:i] + bytes([f[i] ^ 1]) + f[i + 1:])


# 10
def test_token_counts_and_cache(spark, docs, library, tmp_path):
    cache = f"file://{tmp_path}/cache"
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in cases.edge_rows())
    for _ in range(2):
        got = token_counts.token_counts(docs, TOK, cache)
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t, *_ in cases.edge_rows()})
    assert token_counts.token_counts(cases.empty_docs(spark), TOK, cache).count() == 0
    other = queries.tokenizer_path("piece_bpe_32k.model")
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=other)
    texts = docs.filter("text not like '%' || chr(0) || '%'").select("doc_id", "text")
    got = token_counts.token_counts(texts, other, cache).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r.doc_id, len(sp.encode(r.text))) for r in texts.collect()) and spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_encoder_is_exact_on_odd_texts(library):
    from claimlake.llm.encoding import Encoder
    rng = random.Random(4)
    parts = ["don't", "we're", "'s", "a", "B2", "é", "été,", "...", "!?", "12", "3.4", " ", "  ", "\n", "\t", " ", " ", "日本", "<|endoftext|>", "x_y", "(a)", "a.b", "\r\n", "ß's", "²", "Ⅷ,", "\x1c", "​"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", " "]) for _ in range(rng.randrange(25))) for _ in range(1500)]
    enc = Encoder(TOK)
    for a in range(0, len(texts), 100):
        for t, ids in zip(texts[a:a + 100], enc.encode(texts[a:a + 100])):
            assert np.frombuffer(ids, enc.width).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_sql_of_the_native_queries(spark, sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    for name, sql in queries.oracle_sql().items():
        df = queries.QUERIES[name](spark, sf_dir)
        want = con.execute(f"select {', '.join(df.columns)} from ({sql})").fetchall()
        flat = lambda rows: Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
        assert flat(map(tuple, df.collect())) == flat(want), name


def test_native_plans_run_no_python(spark, sf_dir):
    for name in ("op3_mixing", "op8_license_scan"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_work_folder_is_the_shared_one(spark):
    assert common.work_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0])
