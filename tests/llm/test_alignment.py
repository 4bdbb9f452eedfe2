import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import public_tokenizers
from balcao.llm import alignment
from balcao.llm.merging import byte_alphabet
from conftest_llm import corpus

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [*"ab \n\t　\x1c\x0b\xa0\r'sé漢😀.,!1２", "  ", "   ", "the ", " of", "Ing", "</s>", "<|endoftext|>", "<unk>", "▁", "\r\n", " \n ", "ﬁ", "é"]


def texts(n: int, seed: int = 5) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """Ids and bytes of both libraries for the whole text; nothing where the bytes differ."""
    a, b = libraries
    value = {c: i for i, c in enumerate(byte_alphabet())}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.encode(text) if text else []
    raw_a = [bytes([value[c] for c in a.id_to_token(i)]) for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    want = (" " + text).encode()
    if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
        return [], [], [], []
    return ids_a, raw_a, ids_b, raw_b


def groups(libraries, text):
    ids_a, raw_a, ids_b, raw_b = tokens(libraries, text)
    out, i, j = [], 0, 0
    while i < len(ids_a):
        x, y, la, lb = [ids_a[i]], [ids_b[j]], len(raw_a[i]), len(raw_b[j])
        i, j = i + 1, j + 1
        while la != lb:
            if la < lb:
                x.append(ids_a[i])
                la, i = la + len(raw_a[i]), i + 1
            else:
                y.append(ids_b[j])
                lb, j = lb + len(raw_b[j]), j + 1
        out.append((x, y))
    return out


def brute(libraries, rows):
    found = [(i, groups(libraries, t or "")) for i, t in rows]
    count = Counter()
    for _, g in found:
        count.update({(a, b) for x, y in g for a in x for b in y})
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    for i, g in found:
        links = [(a, b) for x, y in g for a in x for b in y]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        yield (
            i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(count[p] == best[p[0]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if g else "",
        )


def key(r):
    return tuple(str(x) for x in r)


def test_stretches_encode_as_the_whole_text(libraries):
    own = alignment.tokenizers(A, B)
    # A written U+2581 reads as a blank, so its text never comes back byte by byte.
    for t in [*(t for t in texts(4000) if "▁" not in t), " ", "  ", "\n", " \n", "x ", "x  ", "x\x1c", "!\x1c ", "\r\n x"]:
        rows = own.rows(alignment.STRETCH.findall(" " + t))
        a, b = (x.take(rows).flatten().to_pylist() for x in own.lists)
        assert a == libraries[0].encode(" " + t, add_special_tokens=False).ids, repr(t)
        assert b == libraries[1].encode(t), repr(t)


def test_table_equals_plain_alignment(spark, docs, empty, libraries):
    more = list(enumerate(texts(300, 8), 1000)) + [(1000, "again"), (1000, "again")]
    rows = [(i, t) for i, t, _ in corpus()] + more
    frame = docs.select("doc_id", "text", "score", "rank").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = alignment.aligned(frame.repartition(5), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(libraries, rows), key=key)
    assert alignment.aligned(empty, A, B).count() == 0


def test_slices_blocks_and_bundles_do_not_matter(libraries, monkeypatch):
    rows = [*texts(40, 11), "", "x" * 3_000, " ".join(texts(60, 12))]
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 3)
    monkeypatch.setattr(alignment, "SLICE_CHARS", 50)
    own = alignment.tokenizers(A, B)
    state = alignment.Rows(own)
    got = [r for pieces in alignment._pieces(rows) for r in state.slice(pieces)]
    assert [r["row"] for r in got] == list(range(len(rows)))
    for r, text in zip(got, rows, strict=True):
        g = groups(libraries, text)
        links = Counter(a * own.size_b + b for x, y in g for a in x for b in y)
        assert dict(zip(r["links"][0].tolist(), r["links"][1].tolist(), strict=True)) == links or not r["same"]
        assert not r["same"] or r["n"]["n_groups"] == len(g)


def test_corpus_pairs(spark, docs, libraries):
    _, pairs = alignment.align(docs.where("doc_id < 30"), A, B)
    want = Counter()
    for i, t, _ in corpus():
        if i is not None and i < 30:
            want.update({(a, b) for x, y in groups(libraries, t) for a in x for b in y})
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(want)
    top = pairs.groupBy("a").agg(F.max("n").alias("m"), F.max(F.when(F.col("best"), F.col("n"))).alias("b")).where("m <> b")
    assert top.count() == 0
