import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from balcao.llm import chunked_bpe
from conftest_llm import corpus

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = [*"ab'stre \n\t　\x1c\x0b\x85\xa0é漢😀.!1２", "'re", "'ll", "   ", "\n\n", "the", "!!!", "xxxxxxxxxxxx", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n: int, longest: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_words_equal_the_library(library):
    own = chunked_bpe.encoder(PATH, public_tokenizers.PATTERN)
    for t in [*texts(3000, 40, 1), "x" * 3000, "ab" * 2000, "é" * 999, "", "a" * 41, "漢字" * 300]:
        ids = own.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(t), repr(t[:80])
        assert own.decode(ids) == t.encode()


def test_every_character_splits_alike(library):
    own = chunked_bpe.encoder(PATH, public_tokenizers.PATTERN)
    some = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x34000), *range(0x3D000, 0x40000), *range(0xE0000, 0xE0200)]]
    text = "".join(f"a{c}1{c} !{c}" for c in some)
    own_ids = own.encode(text)
    assert list(struct.unpack(f"<{len(own_ids) // 4}I", own_ids)) == library.encode_ordinary(text)


def test_cuts_are_boundaries_of_the_whole_text(spark):
    """Common boundaries of neighbouring chunks, for chunks as short as a few characters."""
    split = regex.compile(public_tokenizers.PATTERN).findall
    for chunk, overlap in ((5, 4), (9, 6), (30, 12)):
        for text in texts(3000, 40, chunk):
            true, at = {0}, 0
            for w in split(text):
                at += len(w)
                true.add(at)
            windows = chunked_bpe.cut(text, chunk, overlap)
            found = [chunked_bpe.boundaries(w, split, chunk, overlap, k == len(windows) - 1) for k, w in enumerate(windows)]
            for k in range(1, len(windows)):
                common = {chunk * k + p for p in found[k][0]} & {chunk * (k - 1) + p for p in found[k - 1][1]}
                if common:
                    assert min(common) in true, (text, chunk, k)


@pytest.mark.parametrize(("chunk", "overlap"), [(7, 5), (40, 12), (50_000, 400)])
def test_table_equals_the_library(spark, docs, empty, library, chunk, overlap):
    more = list(enumerate([*texts(150, 80, 4), "x" * 500, " " * 300, "y" * 45 + " " + "z" * 200 + " end", "!" * 60 + "'s" + "t" * 90], 1000))
    more += [(1000, "again " * 50), (1000, "again " * 50)]
    rows = [(i, t or "") for i, t, _ in corpus() if chunk > 1000 or len(t or "") < 1000] + more
    frame = docs.where(F.lit(chunk > 1000) | F.col("text").isNull() | (F.col("n_chars") < 1000)).select("doc_id", "text", "score", "rank")
    frame = frame.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = chunked_bpe.encode(frame, PATH, chunk=chunk, overlap=overlap)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    digest = got.select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("decoded", 256))
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, digest.collect()), key=key) == sorted(want, key=key)
    assert chunked_bpe.encode(empty, PATH).count() == 0


def test_bad_overlap(docs):
    with pytest.raises(ValueError):
        chunked_bpe.encode(docs, PATH, chunk=10, overlap=10)
