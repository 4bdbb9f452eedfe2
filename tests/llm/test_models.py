import zlib
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from balcao.llm import block_labeller, blocks, graph_search, quality, toxicity, uniform_shards
from balcao.llm.tables import held_out
from conftest_llm import words

SAMPLE = "/root/testdata/sf0.01"


def test_toxicity_learns_and_folds():
    rng = np.random.default_rng(1)
    texts = [words(i, 30) + (f" zorgu{rng.integers(99)}x" if i % 3 == 0 else "") for i in range(120)]
    model = toxicity.learn(texts, [int(i % 3 == 0) for i in range(120)])
    a = model.automaton()
    score = lambda t: 1 / (1 + np.exp(-(model.curve[0] + np.dot(model.curve[1:], toxicity.measures(a, t)))))
    assert any(t.startswith("zorgu") or "zorgu".startswith(t) for t in model.terms)
    assert all(score(f"{words(999, 10)} {w} abc") > 0.5 for w in ("zorguxyz", "Z0RGUaa", "zоrgu", "an 1d10t!", "ST​UPID", "ïdiot"))
    assert all(score(t) < 0.5 for t in ("", words(1000, 50), "2024 1,000 v3", "the trash can", "an idiot proof plan"))
    assert toxicity.fold("$tupid id!ot!! 2024 M0R0N") == "stupid idiot!! 2024 moron"
    assert all(score(f"{words(999, 10)} {w} abc") > 0.5 for w in ("1oser", "c1own", "dis9usting", "dis6u5ting", "wor7h1ess"))
    assert toxicity.readings("plain") == ["plain"] and toxicity.readings("1oser 2024") == ["ioser 2024", "loser 2024"]
    assert toxicity.learn([], []).terms and toxicity.learn(["a"], [0]).curve


def labelled(spark, size):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels


@pytest.mark.parametrize(("name", "label", "size"), [("toxicity", "toxic", "sf0.1"), ("quality", "quality", "sf0.01")])
def test_held_out_accuracy(spark, name, label, size):
    docs, labels = labelled(spark, size)
    scored = {"toxicity": toxicity, "quality": quality}[name].classify(docs, labels)
    rows = scored.where("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    y, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    better = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    assert len(rows) > 50 and better > 0.9 and np.all((p >= 0) & (p <= 1))


def test_classifiers_take_any_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0), "x") for i in range(24)] + [(None, 1, 1, "x"), (99, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    for own in (toxicity, quality):
        got = own.classify(docs, labels)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
        assert got.where("score is null or score < 0 or score > 1").count() == 0
        assert own.classify(empty, labels).count() == 0 and own.classify(docs, labels.where("1 = 0")).count() == docs.count()
    for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def naive_hits(model, folded):
    """Terms at word beginnings, the longest of each start, none inside an exception phrase: by plain search."""
    found = {}
    for t, w in model.terms.items():
        at = folded.find(t)
        while at >= 0:
            if not (at and folded[at - 1].isalpha()) and (at not in found or len(t) > found[at][0]):
                found[at] = (len(t), w)
            at = folded.find(t, at + 1)
    spared = []
    for e in map(toxicity.fold, model.exceptions):
        at = folded.find(e)
        while at >= 0:
            end = at + len(e)
            if not (at and folded[at - 1].isalpha()) and not folded[end : end + 1].isalpha():
                spared.append((at, end))
            at = folded.find(e, at + 1)
    return [(s, s + n, w) for s, (n, w) in sorted(found.items()) if not any(x <= s and s + n <= y for x, y in spared)]


def test_automaton_equals_plain_search():
    import random

    model = toxicity.learn([], [])
    a, rng = model.automaton(), random.Random(4)
    parts = [*toxicity.SEEDS, *toxicity.EXCEPTIONS, "can", "fish", "trash ", "x", " ", "!", "idiotic", "clown  fish", "Trash-bin", "m0ron", "7", "é"]
    for _ in range(3000):
        folded = toxicity.fold("".join(rng.choice(parts) + rng.choice(["", " ", " ", "-"]) for _ in range(rng.randint(0, 12))))
        assert toxicity.hits(a, folded) == naive_hits(model, folded), folded


def test_training_rows_are_bounded(spark):
    from balcao.llm import tables

    docs = spark.createDataFrame([(i % 7, f"text {i}") for i in range(900)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(7)], "doc_id long, toxic int")
    got = tables.labelled(docs, labels, "toxic", 4)
    assert got.count() <= 4 and got.select("doc_id").distinct().count() == got.count()


def test_long_texts_are_read_whole():
    model = quality.Model(np.arange(1 << quality.BUCKET_BITS, dtype=np.float32) / 1e5, 0.0)
    parts = list(quality.slices(b"ab " * 800_000))
    assert len(parts) == 3 and sum(map(len, parts)) == 2_400_000 + 2 * (max(quality.GRAMS) - 1)
    assert 0 < model.score("ab " * 800_000) < 1 and model.score("") == 0.5


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">Cookies &amp; more</div><main><article><h1>Title &eacute;</h1><p>First   para <b>bold</b><br>next
<p>Second &lt;p&gt; with <a href=x>link</a></p><script>var a="</p>";</script><ul><li>one<li>two</ul></article></main>
<section id=comments><p>Great!</p></section><form><label>Mail</label></form><footer>(c)</footer>"""


def test_blocks():
    found = blocks.leaves(PAGE)
    assert [b.text for b in found] == ["Site", "Home", "Cookies & more", "Title é", "First para bold next", "Second <p> with link", "one", "two", "Great!", "Mail", "(c)"]
    assert [e.tag for e in found[4].path[-2:]] == ["article", "p"] and found[1].linked == 1.0 and "cookie" in found[2].path[-1].kind.names
    assert blocks.leaves("") == [] and [b.text for b in blocks.leaves("a < b <p")] == ["a < b <p"]
    assert blocks.leaves("<!-- x") == [] and blocks.leaves("<script>x") == []


def weak_text(html):
    found = blocks.leaves(html or "")
    return "\n".join(b.text for b, y in zip(found, block_labeller.weak_labels(found), strict=True) if y)


def test_main_text(spark):
    pages = spark.read.parquet(f"{SAMPLE}/pages.parquet").withColumns({c: F.lit("x") for c in ("text", "id", "h")})
    odd = spark.createDataFrame([(9001, None, None), (9002, "u", ""), (None, "u", PAGE), (9003, "u", PAGE)], "page_id long, url string, html string")
    got = block_labeller.extract(pages.unionByName(odd, allowMissingColumns=True))
    rows = {r["page_id"]: r for r in got.collect()}
    wrong = [i for i, r in rows.items() if r["url"] != "u" and r["text"] != weak_text(r["html"])]
    assert len(wrong) <= 3 and rows[9001]["text"] == rows[9002]["text"] == ""
    assert rows[9003]["text"].split("\n")[:3] == ["Title é", "First para bold next", "Second <p> with link"] and "Cookies" not in rows[9003]["text"]
    assert block_labeller.extract(pages.where("1 = 0")).count() == 0


def test_raw_elements_and_odd_markup():
    text = lambda html: [b.text for b in blocks.leaves(html)]
    assert text("<svg/>text <p>more") == ["text", "more"] and text("a <svg><path d='M0'/></svg> b") == ["a b"]
    assert text("<script src=x /><p>kept") == ["kept"] and text("<title>unclosed <p>kept") == ["unclosed", "kept"]
    assert text("<p title='a > b'>x</p><p title=\"it's\">y") == ["x", "y"] and text("<p class='a>b<p>c") == ["b", "c"]
    assert text("<!doctype html><?xml?><!-- a > b --><p>x") == ["x"] and text("1 < 2 > 0") == ["1 < 2 > 0"]
    assert "w12" not in blocks.leaves(f"<div class='{' '.join('abcdefghijklmnop')}'>x")[0].path[0].kind.names
    assert blocks.leaves(f"<div class='{' '.join('abcdefghijklmnop')} footer'>x")[0].path[0].kind.names[-1] == "footer"
    assert [e.tag for e in blocks.leaves("<ul><li>a<ul><li>b</ul><li>c</ul>")[2].path] == ["ul", "li"]


@pytest.mark.parametrize("unit", ["<script ", '<a "', '<a ="', '<a =">', "<div>x", "<", "<!--", "<svg>", "<script>", "<title>x", "<td><div>x", "</div>", "&", "<li></li>x", "<object>x"])
def test_broken_markup_takes_linear_time(unit):
    import time

    page = unit * (1_000_000 // len(unit))
    start = time.process_time()
    blocks.leaves(page)
    assert time.process_time() - start < 4
    blocks.leaves(page + ">" + '"')


PARAGRAPHS = "".join(f"<p>This is paragraph {i} of the story, and it goes on for a while with some words in it.</p>" for i in range(12))
LINKS = "".join(f'<a href="/{i}">Item {i}</a> ' for i in range(9))
ITEMS = "".join(f"<li><a href=/{i}>Item {i}</a>" for i in range(8))
SAID = "".join(f"<div class=comment><p>I think that this is a very long reader comment number {i}, and I disagree.</p></div>" for i in range(30))
LAYOUTS = (
    "<div class=c1><ul>{items}</ul></div><div class=c2>{text}</div>",
    '<nav>{links}</nav><article class="has-social-share">{text}</article><footer>(c) 2024</footer>',
    '<div id="page-with-sidebar"><div class=sidebar>{links}</div><main>{text}</main></div>',
    "<header>{links}</header>{text}<footer>contact us</footer>",
    '<div class="x9"><a href=a>Home</a> <a href=b>News</a></div><section class=zq>{text}</section><div class=k3><p><a href=q>Read more</a></p></div>',
    "<div class=wrap><div class=top>{links}</div><div class=body><h1>Title here</h1><div class=txt>{paragraphs}</div></div></div>",
    "<article>{text}</article><section id=comments>{said}</section>",
    "<div class=kopf>{links}</div><div class=mitte><div class=links><ul>{items}</ul></div><div class=inhalt>{text}</div></div>",
    "<table><tr><td><ul>{items}</ul></td><td>{text}</td></tr></table>",
    "<div class=q1><div class=q2>{links}</div><div class=q3>{text}</div><div class=q4><ul>{items}</ul></div></div>",
    "<div class=cookie-notice><p>We use cookies to make this site work better for you.</p></div><div class=story>{text}</div><div class=related><ul>{items}</ul></div>",
    "<div role=navigation>{links}</div><div role=main>{text}</div><div role=contentinfo>About us</div>",
    "<main><div class='share'>{links}</div>{text}<div class=newsletter><p>Sign up for our newsletter to get the best stories every week.</p></div></main>",
    "<body class='no-sidebar has-banner'><div class=promo>{links}</div><div id=content>{text}</div>",
    "<form><label>Search</label></form><div class='entry'>{text}</div><div class='comment-list'>{said}</div>",
    "<ul class=m>{items}</ul><div class=t>{text}</div><ul class=m>{items}</ul>",
    "<div><div>{links}</div><div>{text}</div></div>",
    "<section><h3>More</h3><ul>{items}</ul></section><section>{text}</section>",
    "<aside><p>An aside that says a few words about something else entirely.</p></aside><article><header><h1>Title here</h1></header>{paragraphs}</article>",
    "<dialog><p>Please accept these terms before you go on reading here.</p></dialog><div class=lang-en><div class=b1>{text}</div></div>",
)


@pytest.fixture(scope="module")
def fitted(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return block_labeller.fit(pages)


def test_other_layouts(fitted):
    """Marked by hand: the title and the paragraphs are the text, everything else is not. F1 over blocks above 0.95."""
    hit = extra = lost = 0
    for layout in LAYOUTS:
        html = layout.format(text="<h1>Title here</h1>" + PARAGRAPHS, paragraphs=PARAGRAPHS, links=LINKS, items=ITEMS, said=SAID)
        (got,) = block_labeller.extract_batch(fitted, [html])
        want = {"Title here"} | {b.text for b in blocks.leaves(PARAGRAPHS)}
        lines = got.split("\n") if got else []
        hit, extra, lost = hit + len(want & set(lines)), extra + len([x for x in lines if x not in want]), lost + len(want - set(lines))
    assert 2 * hit / (2 * hit + extra + lost) > 0.95, (hit, extra, lost)


def test_lstm_equals_a_plain_loop(fitted):
    """Forward pass of one direction, step by step in Python floats, against the batched one."""
    page = block_labeller.vectors(blocks.leaves(PAGE))
    w = {k: v.astype(float) for k, v in fitted.weights.items()}
    h = block_labeller.HIDDEN
    sigmoid = lambda z: 1 / (1 + np.exp(-z))

    def states(x, wx, wh):
        out, s, c = [], np.zeros(h), np.zeros(h)
        for row in x:
            z = row @ wx + s @ wh
            c = sigmoid(z[h : 2 * h] + 1) * c + sigmoid(z[:h]) * np.tanh(z[3 * h :])
            s = sigmoid(z[2 * h : 3 * h]) * np.tanh(c)
            out.append(s)
        return np.array(out)

    x = page.astype(float)
    both = np.concatenate((states(x, w["fx"], w["fh"]), states(x[::-1], w["bx"], w["bh"])[::-1]), 1)
    plain = both @ w["out"][:, 0] + x @ w["own"][:, 0]
    batch, mask = block_labeller.Labeller.pad([page, page[:3]])
    assert np.allclose(fitted.logits(batch, mask)[0][: len(page), 0], plain, atol=1e-3)


def test_training_takes_any_pages(spark):
    """Long pages only, null ids, repeated and blank pages: never an untrained model."""
    long = PAGE.replace("First   para", "First long para. " * 20_000)
    rows = [(None, long), (None, long), (1, ""), (2, None), (3, "<p></p>")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = [r["text"] for r in block_labeller.extract(pages).collect()]
    assert got[2:] == ["", "", ""] and got[0] == got[1] and got[0].startswith("Title é\nFirst long para.") and "Cookies" not in got[0]
    assert block_labeller.fit(pages.where("page_id > 0")) is None


def test_neighbours_recall_and_odd_rows(spark):
    vectors = spark.read.parquet(f"{SAMPLE}/embeddings.parquet").select("vec_id", "embedding")
    rows = vectors.collect()
    x = np.array([r["embedding"] for r in rows], float)
    odd = [(9001, None), (9002, []), (9003, [0.0] * 64), (9004, [None] + [1.0] * 63), (9005, [float("nan")] * 64), (9006, [float("inf")] * 64), (None, [1.0] * 64), (9007, [1.0, 2.0])]
    copies = [(9100 + i, [float(v) for v in x[0]]) for i in range(15)]
    extra = spark.createDataFrame(odd + copies, "vec_id long, embedding array<float>")
    everything = vectors.unionByName(extra).withColumns({c: F.lit("x") for c in ("id", "vector", "shard", "rank")})
    got = graph_search.nearest(everything, everything.where("vec_id % 50 = 0 or vec_id = 9007 or vec_id = 9003"), 10, shard_points=150)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    ids = np.array([r["vec_id"] for r in rows] + [c[0] for c in copies])
    points = np.concatenate((x, np.array([c[1] for c in copies], np.float32).astype(float)))
    hit = n = 0
    for q, near in found.items():
        d = np.sqrt(((points - points[ids == q][0]) ** 2).sum(1))
        want = [i for _, i in sorted((v, i) for v, i in zip(d, ids, strict=True) if i != q)][:10]
        hit, n = hit + len(set(want) & {i for i, _ in near}), n + 10
        assert all(abs(s - d[ids == i][0]) < 1e-9 for i, s in near) and len(near) == 10
    assert set(found) == {*range(0, 500, 50), 9100} and hit / n >= 0.9
    assert [i for i, _ in found[0]] == [9100 + i for i in range(10)]
    assert graph_search.nearest(vectors.where("1 = 0"), vectors).count() == 0


def test_shards_are_exact(docs, empty):
    rows = uniform_shards.shard_documents(docs.repartition(5), 4, seed=3).collect()
    assert len(rows) == docs.count()
    for s in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(rows) / 4) < 1
    assert all(r["size"] >= 1 for r in rows) and uniform_shards.shard_documents(empty).count() == 0
    many = uniform_shards.assign(docs.select("doc_id", "text"), 4, range_rows=2).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert all(r["m"] == r["n"] - 1 for r in many)


def test_matrix_has_exact_margins(spark):
    sizes = spark.createDataFrame([(10, 5), (11, 0), (30, 1000), (31, 65536), (50, 7)], "part long, rows long")
    rows = uniform_shards.communication_matrix(sizes, 16, 3).orderBy("part").collect()
    assert [sum(r["counts"]) for r in rows] == [5, 0, 1000, 65536, 7]
    columns = np.array([r["counts"] for r in rows]).sum(0)
    assert columns.max() - columns.min() <= 1 and all(min(r["counts"]) >= 0 for r in rows)


def test_draws_are_hypergeometric(spark):
    good, total, draws = (F.lit(v).cast("long") for v in (7, 20, 6))
    u = uniform_shards.uniform(F.col("id"))
    counts = spark.range(100_000).select(uniform_shards.hypergeometric(u, good, total, draws).alias("k")).groupBy("k").count().collect()
    for r in counts:
        p = comb(7, r["k"]) * comb(13, 6 - r["k"]) / comb(20, 6)
        assert abs(r["count"] / 100_000 - p) < 5 * (p * (1 - p) / 100_000) ** 0.5 + 1e-4




def exact_nearest(rows, q, v, k):
    """(id, distance) by brute force; the query's own row once left out."""
    far = sorted((float(np.sqrt(((np.array(x, float) - np.array(v, float)) ** 2).sum())), i) for i, x in rows)
    far.remove((0.0, q))
    return [(i, d) for d, i in far[:k]]


def test_neighbour_ties_and_repeated_ids(spark):
    """128 candidates at one distance, and an id with three vectors."""
    rng = np.random.default_rng(5)
    points = []
    for i in range(128):
        v = [0.0] * 64
        v[i % 64] = 1.0 if i < 64 else -1.0
        points.append((1000 - i, v))
    points += [(2000 + i, [float(x) for x in rng.normal(5, 1, 64)]) for i in range(300)]
    centre = [(100, [1e-30] + [0.0] * 63)]
    repeated = [(200, [float(x) for x in rng.normal(5, 1, 64)]) for _ in range(3)]
    rows = points + centre + repeated
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_search.nearest(frame, frame.where("vec_id in (100, 200)"), 10, beam=32, shard_points=500)
    found = got.where("query_id = 100").orderBy("rank").collect()
    assert [r["id"] for r in found] == sorted(i for i, _ in points[:128])[:10] and {r["score"] for r in found} == {1.0}
    of_200 = sorted((r["rank"], r["id"], r["score"]) for r in got.where("query_id = 200").collect())
    want = sorted((k + 1, i, d) for _, v in repeated for k, (i, d) in enumerate(exact_nearest(rows, 200, v, 10)))
    assert len(of_200) == 30 and len(set(want) & set(of_200)) >= 27


def test_neighbour_recall_at_full_shards(spark):
    """Shards of the production size, 4,096 points each, against brute force."""
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (40, 64))
    x = (centres[rng.integers(0, 40, 12_000)] + rng.normal(0, 0.5, (12_000, 64))).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8)
    got = graph_search.nearest(frame, frame.where("vec_id % 100 = 0"), 10)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    y, hit = x.astype(float), 0
    for q, ids in found.items():
        d = ((y - y[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(ids & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert len(found) == 120 and hit / 1200 >= 0.9
    print("recall at full shards", hit / 1200)
