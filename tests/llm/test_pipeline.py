import hashlib
import struct

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from balcao.llm import decontaminate, line_spread, path_join, quality
from balcao.llm.queries import MIN_LINE_WORDS, MIN_SITES, SHINGLE, SIMILARITY
from balcao.llm.tables import table
from conftest_llm import words
from test_copies import brute

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert counts[0] >= counts[1] == counts[2] > counts[3] > counts[4] > 0
    joined = path_join.join(docs)
    assert joined.where("doc_id <> class_id").count() == 0
    assert decontaminate.find(docs, table(spark, SF, "benchmark")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == counts[-1]


def test_rejected_documents_go(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    monkeypatch.setattr(corpus_pipeline, "KEEP_SCORE", 2.0)
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).count() == 0


def test_run_equals_brute_force(spark):
    """Every stage again without its method: scores one by one, SQL over all lines and shingles, all pairs, the public library."""
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(documents, labels)
    rows = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    rows = [r for r in rows if model.score(r[1] or "") >= corpus_pipeline.KEEP_SCORE]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    cut = con.execute(line_spread.SQL.format(sites=MIN_SITES, gaps=MIN_LINE_WORDS - 1)).fetchall()
    texts = {doc: text for doc, _, _, text in cut}
    classes = brute([(doc, text or "") for doc, text in texts.items()], SIMILARITY)
    texts = {doc: text for doc, text in texts.items() if classes[doc, text or ""][0] == doc}
    con.execute("DELETE FROM documents")
    con.executemany("INSERT INTO documents VALUES (?, ?, NULL)", list(texts.items()))
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    leaked = {r[0] for r in con.execute(decontaminate.SQL.format(width=SHINGLE, threshold=SIMILARITY)).fetchall()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for doc in sorted(texts.keys() - leaked):
        ids = library.encode(texts[doc] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), *(hashlib.sha256(b).hexdigest() for b in (struct.pack(f"<{len(ids)}I", *ids), decoded.encode()))))
    assert leaked and len(rows) > len(texts) > len(want) > 0
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


def test_stages_take_odd_rows(spark, docs, empty, monkeypatch):
    """Nulls, empty and long texts, repeated rows, clashing extra columns and empty tables in every stage."""
    monkeypatch.setattr(corpus_pipeline, "KEEP_SCORE", 0.0)
    stages = dict(corpus_pipeline.STAGES)
    counts = {}
    for name, stage in stages.items():
        columns = list(corpus_pipeline.COLUMNS) if name != "tokens" else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        got = stage(spark, docs, SF)
        assert got.columns == columns
        counts[name] = (got.count(), got.where("doc_id is null").count())
        assert stage(spark, empty, SF).count() == 0
    # The near copies lose a second row of document 31, 31 itself, 32 and 33.
    n = docs.count()
    assert counts == {name: (n - 4 if name == "near copies" else n, 2) for name in stages}
    nulls = stages["lines"](spark, docs, SF).where("doc_id = 40").first()
    assert nulls["text"] is None and nulls["n_chars"] == 0


def test_copies_over_many_sources_leave_one_whole_text(spark):
    """Exact and near copies over 12 sources, and a line of all documents that is boilerplate; one text of each group stays whole."""
    line = "a line that every document shows"
    exact, near = ([words(s + k, 30) for k in range(10)] for s in (2_000, 3_000))
    rows = [(i, "\n".join([words(4_000 + i, 40), line, words(4_100 + i, 40)]), f"s{i % 12}") for i in range(24)]
    rows += [(100 + i, "\n".join([*exact, line]), f"s{i}") for i in range(12)]
    for i in range(12):
        changed = near[i % 10].split(" ")
        changed[3 + i // 10] = f"changed{i}"
        rows.append((200 + i, "\n".join([*near[: i % 10], " ".join(changed), *near[i % 10 + 1 :], line]), f"s{i}"))
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    cut = stages["lines"](spark, docs, SF)
    cut = spark.createDataFrame(cut.collect(), cut.schema)
    assert sorted(r["doc_id"] for r in cut.where(f"contains(text, '{line}')").collect()) == [0]
    kept = {r["doc_id"]: r["text"] for r in stages["near copies"](spark, cut, SF).collect()}
    whole = {i: t for i, t, _ in rows}
    assert sorted(kept) == [*range(24), 100, 200]
    assert kept[0] == whole[0] and kept[1] == whole[1].replace(f"{line}\n", "")
    assert all(kept[i] == whole[i].removesuffix(f"\n{line}") for i in (100, 200))


def test_lines_of_few_and_hot_sources_go(spark):
    """A passage in five sources, and one whose documents lie mostly in a hot source; one in two sources stays."""
    few, hot, rare = (words(s, 60) for s in (5_001, 5_002, 5_003))
    rows = [(i, few, f"s{i}") for i in range(5)] + [(10 + i, hot, f"s{max(0, i - 15)}") for i in range(20)]
    rows += [(40 + i, rare, f"s{i % 2}") for i in range(12)]
    rows = [(i, "\n".join([words(6_000 + i, 30), t, words(6_100 + i, 30)]), s) for i, t, s in rows]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for cut in (corpus_pipeline.drop_shared_lines(spark, docs, SF), line_spread.dedup_lines(docs, MIN_SITES, MIN_LINE_WORDS)):
        got = {r["doc_id"]: r["text"] for r in cut.collect()}
        assert {i for i, t in got.items() if few in t or hot in t or rare in t} == {0, 10, *range(40, 52)}
