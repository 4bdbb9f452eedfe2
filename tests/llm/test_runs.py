import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from balcao.llm import periodic_runs
from conftest_llm import corpus


def brute(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) by comparing every place at every lag."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i : i + length]
            smaller = any(all(stretch[t] == stretch[t + p] for t in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed: int, n: int) -> list[list[int]]:
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 120):
            block = [rng.randint(0, 2) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 9, 14, 20]))]
            words += block * rng.randint(1, 7) + block[: rng.randint(0, len(block))]
        out.append(words)
    return out


def test_runs_equal_brute_force():
    for seed in range(6):
        docs = texts(seed, 60)
        starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        got = periodic_runs.runs(np.array([w for d in docs for w in d], np.int64), starts).tolist()
        assert got == [[d, *r] for d, words in enumerate(docs) for r in brute(words)]


def test_scales_hold_the_guarantee():
    seen = []
    for k, low, high in periodic_runs.scales(100_000):
        for q in range(low, high + 1):
            assert 2 * q - 1 <= k <= max(6, 4 * q) - q
            seen.append(q)
    assert seen == list(range(1, 25_001)) or seen[:25_000] == list(range(1, 25_001))


def test_one_word_fills_a_long_text():
    words = np.zeros(1_000_000, np.int64)
    assert periodic_runs.runs(words, np.array([0, len(words)])).tolist() == [[0, 0, 1_000_000, 1]]
    block = np.arange(1000).repeat(1)
    assert periodic_runs.runs(np.tile(block, 500), np.array([0, 500_000])).tolist() == [[0, 0, 500_000, 1000]]


def expected(doc_id, text, replay=True):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if replay and doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = best[1] * 1000 // best[2] if found else None
    listed = sha("".join(f"{s},{length},{q}\n" for s, length, q in found))
    return doc_id, len(found), *best, milli, listed, sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def test_table(spark, docs, empty):
    more = [(1000 + i, " ".join(f"w{w}" for w in d)) for i, d in enumerate(texts(9, 80))]
    more += [(2000, "a\x1cb\x85c d e  a\tb\n\x0bx\x0cy\rz "), (2001, "é É é É é É é É"), (2000, "a a a a a a")]
    rows = [(i, t) for i, t, _ in corpus() if t is None or len(t) < 20_000] + more
    frame = docs.where("n_chars < 20000").select("doc_id", "text", "score", "label").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    )
    got = periodic_runs.digest(periodic_runs.find_runs(frame, periodic_runs.replay_tenth))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(i, t) for i, t in rows), key=key)
    assert periodic_runs.digest(periodic_runs.find_runs(empty)).count() == 0


def test_long_text(docs):
    found = periodic_runs.find_runs(docs.where("n_chars >= 20000"))
    for r in found.select("doc_id", "n_words", F.size("runs").alias("n")).collect():
        assert (r["n_words"], r["n"]) == {45: (1, 0), 46: (6_000, 0)}[r["doc_id"]]


@pytest.mark.parametrize("size", [1, 50])
def test_slices_do_not_matter(docs, monkeypatch, size):
    frame = docs.where("doc_id < 40")
    want = sorted(periodic_runs.digest(periodic_runs.find_runs(frame)).collect())
    rows = frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).toArrow()
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", size)
    import pyarrow as pa
    import pyarrow.compute as pc

    got = []
    sizes = pc.binary_length(rows["text"]).to_numpy()
    for begin, end in periodic_runs._slices(sizes):
        part = rows.slice(begin, end - begin)
        got += periodic_runs._slice(part["doc_id"].to_pylist(), part["text"].combine_chunks().cast(pa.large_string()), None)["runs"].to_pylist()
    assert [len(r) for r in got] == [r["n_runs"] for r in sorted(want)] or sum(map(len, got)) == sum(r["n_runs"] for r in want)
