import hashlib
import struct

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from balcao.llm import merging, speculative_bpe, token_counts
from conftest_llm import corpus

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LETTERS = "aab cE'st  \n\t　éÉßΣİ१३.,!#\x1c\x85​ﬁ漢😀"



def test_many_texts_equal_the_library():
    rng = __import__("random").Random(3)
    texts = ["".join(rng.choice([*LETTERS, "<|endoftext|>", "<|startoftext|>", "ing", "the "]) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["x" * 5_000, "ab" * 4_000, "", "aaaa" * 3_000]
    own, library = token_counts.counter(BYTES), Tokenizer.from_file(BYTES)
    assert [own.text(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    fast, library = speculative_bpe.speculator(WORDS), Tokenizer.from_file(WORDS)
    for t, (n, ids, decoded) in zip(texts, fast.encode(texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), struct.pack(f"<{len(want)}I", *want), library.decode(want, skip_special_tokens=False))


def test_heap_merges_equal_plain_merging():
    m = merging.load(BYTES)
    for word in ("reorganization", "aaaaaaa", " zzzzzz", "hello"):
        symbols = m.symbols(word)
        merges = 0
        while True:
            found = [(m.pair[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in m.pair]
            if not found:
                break
            _, i = min(found)
            symbols[i : i + 2] = [m.pair[symbols[i], symbols[i + 1]][1]]
            merges += 1
        assert m.merge(m.symbols(word))[0] == merges


def test_rejected_proposals_are_merged_exactly():
    own = speculative_bpe.speculator(WORDS)
    vocabulary = sorted(s.removesuffix("</w>") for s in own.merges.vocab if s.isascii() and s.removesuffix("</w>").isalpha())
    made = [a + b for a, b in zip(vocabulary[::97], vocabulary[50::89], strict=False)]
    assert any(own.propose(w) != own.exact(w) for w in made)
    assert own.encode_words(made) == [own.exact(w) for w in made]


def test_count_table(docs, empty):
    rows = [(i, t or "") for i, t, _ in corpus()]
    library = Tokenizer.from_file(BYTES)
    want = sorted((i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in rows if i is not None)
    got = token_counts.count_tokens(docs, BYTES)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.where("doc_id is not null").collect())) == want
    assert got.count() == len(rows) and token_counts.count_tokens(empty, BYTES).count() == 0


def test_encode_table(docs, empty):
    library = Tokenizer.from_file(WORDS)
    got = speculative_bpe.encode(docs, WORDS).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("d"), speculative_bpe.ids_array(F.col("ids")).alias("a"))
    want = {}
    for i, t, _ in corpus():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), ids)
    rows = got.where("doc_id is not null").collect()
    assert len(rows) == len([1 for i, _, _ in corpus() if i is not None])
    for r in rows:
        assert (r["n_tokens"], r["d"], r["a"]) == want[r["doc_id"]]
    assert speculative_bpe.encode(empty, WORDS).count() == 0
