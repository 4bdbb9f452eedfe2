"""Small corpora with nulls, empty and long texts, copies, repeated rows and clashing column names."""

from __future__ import annotations

import random

#: Names that operators use inside, as extra columns.
EXTRA = ("doc", "path", "rank", "label", "score", "n_tokens", "value", "item")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text, source) rows."""
    base = words(1, 60)
    near = base.split(" ")
    near[5] = "changed"
    rows = [(i, words(100 + i, 40) + f"\nshared line of many sites\n{words(500 + i, 10)}", f"s{i % 12}") for i in range(24)]
    rows += [(30, base, "s1"), (31, base, "s2"), (32, " ".join(near), "s3"), (33, base, None), (31, base, "s2")]
    rows += [(40, None, "s1"), (41, "", "s2"), (42, "   \n \t", None), (43, "word", "s1"), (44, "Σ İ ﬁ 漢字 <|endoftext|> é", "s2")]
    rows += [(45, "x" * 30_000, "s1"), (46, words(7, 6_000), "s2"), (None, words(8, 30), "s1"), (None, None, None)]
    return rows
