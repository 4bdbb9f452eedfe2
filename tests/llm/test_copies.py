import duckdb
import numpy as np
from pyspark.sql import functions as F

from balcao.llm import decontaminate, line_spread, path_join
from conftest_llm import corpus, words


def sets(text):
    return set(path_join.shingle_set(text).tolist())


def brute(rows, threshold=0.8):
    """class_id and n_links of (doc, text) rows with words, by all pairs."""
    found = {}
    for doc, text in rows:
        s = frozenset(sets(text))
        if s:
            found[s] = min(doc, found.get(s, doc))
    links = {a: [b for b in found if a != b and len(a & b) >= threshold * len(a | b)] for a in found}
    out = {}
    for doc, text in rows:
        s = frozenset(sets(text))
        seen, todo = {s}, [s]
        while todo:
            for b in links.get(todo.pop(), []):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out[doc, text] = (min(found[x] for x in seen), len(links[s])) if s else (doc, 0)
    return out


def test_join_equals_brute_force(spark, docs, empty):
    rows = [(i, t or "") for i, t, _ in corpus() if i is not None]
    want = sorted((i, *brute(rows)[i, t]) for i, t in rows)
    got = path_join.join(docs)
    assert sorted(map(tuple, got.where("doc_id is not null").collect())) == want
    assert {tuple(r) for r in got.where("doc_id is null").collect()} == {(None, None, 0)}
    assert path_join.join(empty).count() == 0


def test_large_near_group_in_blocks(spark, monkeypatch):
    """A group above every bound, so buckets and clusters are looked at in blocks."""
    for name, value in {"LEAF": 16, "PART": 8, "BLOCK_MEMBERS": 8}.items():
        monkeypatch.setattr(path_join, name, value)
    base = words(3, 80).split(" ")
    rows = [(i, " ".join(base[: i % 70] + [f"w{i}"] + base[i % 70 + 1 :])) for i in range(60)] + [(100 + i, words(900 + i, 50)) for i in range(30)]
    want = sorted((i, *brute(rows)[i, t]) for i, t in rows)
    got = path_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == want
    assert max(n for _, _, n in want) > 30


def test_one_of_each_group_stays(docs):
    kept = [r["doc_id"] for r in path_join.first_of_groups(docs).collect()]
    assert [i for i in kept if i in (30, 31, 32, 33)] == [30]
    assert sorted(i for i in kept if i is not None) == sorted({i for i, _, _ in corpus() if i is not None} - {31, 32, 33})
    assert kept.count(None) == 2


def test_rows_that_share_an_id_or_have_none_are_judged_alone(spark):
    a, b, c, d = (words(s, 40) for s in (6_001, 6_002, 6_003, 6_004))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (None, a), (None, "x " + words(6_005, 50)), (None, words(6_005, 50)), (None, ""), (None, ""), (None, None)]
    rows += [(7, words(6_006, 40))] * 2 + [(8, ""), (8, "")]
    got = path_join.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, got.collect()), key=str)
    unnamed = [t for i, t in got if i is None]
    assert [r for r in got if r[0] is not None] == sorted([(1, a), (5, b), (6, c), (6, d), (7, words(6_006, 40)), (8, "")], key=str)
    assert len(unnamed) == 4 and sum(words(6_005, 50) in (t or "") for t in unnamed) == 1 and a not in unnamed


def test_buckets_whose_short_sums_agree_are_both_looked_at(spark):
    """Two pairs of classes whose 40-bit hashes have the same sum."""
    h = np.array([r[0] for r in spark.range(6_000).select(F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))).collect()])
    a, b = np.triu_indices(len(h), 1)
    order = np.argsort(h[a] + h[b], kind="stable")
    at = np.flatnonzero(np.diff((h[a] + h[b])[order]) == 0)[0]
    pairs = [(int(a[k]), int(b[k])) for k in order[at : at + 2]]
    rows = [(rep, bytearray(path_join.sketch(path_join.shingle_set(words(7_000 + k, 50))).tobytes())) for k, pair in enumerate(pairs) for rep in pair]
    links = path_join.propose(spark.createDataFrame(rows, "rep long, sketch binary"), 0.8, 0.99999)
    assert {tuple(sorted(r)) for r in links.collect()} == set(pairs) and len({i for p in pairs for i in p}) == 4


def test_extinction_gives_the_recall():
    runs = path_join.runs_for(0.99999, 0.8)
    assert path_join.extinction(0.8) ** runs <= 1e-5 < path_join.extinction(0.8) ** (runs - 1)


def test_shingles_do_not_see_case_or_signs():
    assert sets("One two, THREE four five six") == sets("one two three - four five six!")
    assert len(sets("a b")) == 1 and not sets(" .,;") and sets("a b") != sets("b a")
    many = path_join.shingle_set(words(4, 3000))
    assert len(many) == 2996 and np.all(np.diff(many.astype(object)) > 0)


def view(name, rows, columns):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE {name} ({columns})")
    con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con


def test_lines(spark, docs, empty):
    got = line_spread.dedup_lines(docs, min_sites=10)
    assert set(got.columns) == {*docs.columns, "n_lines", "n_removed"} and got.count() == docs.count()
    rows = {r["doc_id"]: r for r in got.where("doc_id < 30").collect()}
    assert rows[0]["n_removed"] == 0 and "shared line" in rows[0]["text"]
    assert all(rows[i]["n_removed"] == 1 and rows[i]["n_lines"] == 3 and "shared line" not in rows[i]["text"] for i in range(1, 24))
    null, blank = (got.where(f"doc_id = {i}").first() for i in (40, 41))
    assert (null["text"], null["n_lines"], null["n_removed"]) == (None, 0, 0) and (blank["text"], blank["n_lines"]) == ("", 1)
    assert got.where("doc_id = 31").count() == 2 and line_spread.dedup_lines(empty).count() == 0


def test_lines_equal_sql_at_every_threshold(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "\n".join(f" common line number {k} " for k in rng.integers(0, 12, 6)), f"s{rng.integers(0, 14)}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites in (8, 11, 14):
        want = view("documents", rows, "doc_id BIGINT, text VARCHAR, source VARCHAR").execute(line_spread.SQL.format(sites=sites, gaps=2)).fetchall()
        got = line_spread.dedup_lines(docs, sites, 3).select("doc_id", "n_lines", "n_removed", "text").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_decontamination(spark, docs, empty):
    texts = {i: t for i, t, _ in corpus()}
    long_text = texts[46].split(" ")
    items = [(1, " ".join(long_text[3000:3040])), (2, " ".join(texts[30].split(" ")[10:40]).upper()), (3, words(77, 30)), (4, None), (5, ""), (6, "word"), (None, texts[30])]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc string")
    got = decontaminate.find(docs, bench)
    pairs = {(r["doc_id"], r["item_id"]): r["containment"] for r in got.collect()}
    want = {}
    norm = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 4)) if w}
    for i, t, _ in corpus():
        for j, b in items:
            if i is not None and j is not None and norm(b) and len(norm(b) & norm(t)) >= 0.8 * len(norm(b)):
                want[i, j] = len(norm(b) & norm(t)) / len(norm(b))
    assert pairs == want and (46, 1) in pairs and (30, 2) in pairs and (43, 6) in pairs
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(docs, bench.where("1 = 0")).count() == 0
    left = decontaminate.remove(docs, bench)
    assert left.where("doc_id is null").count() == 2 and left.where("doc_id in (30, 46, 43)").count() == 0


def test_signature_keeps_the_least_of_each_bin(spark):
    rows = spark.range(1).select(F.expr("transform(sequence(1, 300), x -> xxhash64(x))").alias("hashes"))
    hashes, signature = rows.first()[0], decontaminate.signed(rows, 0).first()[0]
    least = {}
    for h in hashes:
        least[h >> 55] = min(h, least.get(h >> 55, h))
    assert signature == sorted(least.values())
    assert decontaminate.fill_for(1) > decontaminate.fill_for(30) == 0


def contained(text, item, width=5):
    """Share of the item's distinct runs of words in the text; a shorter item counts as one run."""
    import re

    find = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    w, b = find(text), find(item)
    n = min(width, len(b))
    runs = lambda x: {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}
    return len(runs(w) & runs(b)) / len(runs(b)) if b else 0.0


def test_short_items_and_rows_without_an_id_of_their_own(spark):
    """Items of one to six words anywhere in a text; null and repeated ids are judged row by row."""
    texts = [
        (1, "one two three four five six seven eight"), (1, "quite another clean text of some length here"), (None, "say three four five again"),
        (None, "clean words only in this row of the table"), (2, "three four"), (3, ""), (4, None), (5, "THREE, four; five"), (5, "THREE, four; five"),
        (6, "five four three"), (7, "zebra"), (8, " ".join(f"w{i}" for i in range(500)) + " three four five"),
    ]
    items = [(1, "three four five"), (2, "zebra"), (3, "four five"), (4, "w3 w4 w5 w6 w7 w8"), (5, "two three four five"), (6, "..."), (None, "six")]
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, item string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, j) for i, t in texts for j, b in items if j is not None and contained(t, b) >= 0.8}
    got = decontaminate.find(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    left = sorted(str(tuple(r)) for r in decontaminate.remove(docs, bench).select("doc_id", "text").collect())
    clean = [(i, t) for i, t in texts if not any(j is not None and contained(t, b) >= 0.8 for j, b in items)]
    assert left == sorted(map(str, clean))
    with duckdb.connect() as con:
        documents, benchmark = docs.toPandas(), bench.toPandas()  # noqa: F841
        rows = con.sql(decontaminate.SQL.format(width=5, threshold=0.8)).fetchall()
    assert {(None if i != i else i, j) for i, j, *_ in rows} == {(i, j) for i, j in want}


def test_a_text_of_many_lines_is_cut_in_time(spark):
    import time

    shared = [f"the shared line number {i}" for i in range(60_000)]
    own = [f"only here {i} and nowhere" for i in range(60_000)]
    long = "\n".join(x for pair in zip(shared, own, strict=True) for x in pair)
    rows = [(1, "\n".join(shared), "a"), (2, "\n".join(shared), "b"), (3, long, "c"), (4, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    start = time.time()
    got = {r["doc_id"]: r for r in line_spread.dedup_lines(docs, 3, 3).collect()}
    assert time.time() - start < 60
    assert got[3]["text"].split("\n") == own and (got[3]["n_lines"], got[3]["n_removed"]) == (120_000, 60_000)
    assert got[1]["text"] == rows[0][1] and got[2]["text"] == "" and (got[4]["text"], got[4]["n_lines"]) == (None, 0)
