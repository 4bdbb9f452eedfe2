"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts and accented letters to plain ones, digits and signs that
stand for letters inside words. The lexicon's terms are word beginnings; their weights are log odds learned from labelled rows, with a
few seed terms for corpora whose labels show too little. Hits inside exception phrases do not count. The score is a
logistic function of the weighted hits, as they are and normalised by length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import tables

#: Bound of the training sample, in labelled rows; it bounds the fit, not the scoring.
MAX_TRAINING_ROWS = 4000
#: Bounds of a term's length in letters.
SHORTEST, LONGEST = 4, 10
#: A term must explain so many toxic rows that no better term explains, and pass a likelihood ratio of G2.
SUPPORT, G2 = 5, 30.0
SEED_WEIGHT = 4.0
#: One hit weighs against at least so many words.
LENGTH_FLOOR = 20

# Seed terms, and phrases in which such words are harmless.
SEEDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
EXCEPTIONS = ("clown fish", "class clown", "circus clown", "idiot proof", "loser bracket", "pond scum", "trash bin", "trash can", "trash bag", "trash collection")
# Look-alikes of Greek, Cyrillic and other letters, then digits and signs, each above the letter it stands for.
LOOKALIKES = (
    "абвгеёзійкмнорстухцԁԍіјѕһӏԛԝαβγεζηικνορτυχωƅɑɡɩıłøđðþæœꞌ",
    "abbreeziikmhopctyxudgijshlqwabyezniknoptuxwbagiilodopaoi",
)
DIGITS = ("0134578", "oieastb")
# The second reading of digits that stand for more than one letter, or seldom for one.
SECOND_DIGITS = ("0123456789", "olzeasgtbg")
SIGNS = ("@$!|", "asil")

_TABLE = dict(zip(map(ord, LOOKALIKES[0]), LOOKALIKES[1], strict=True)) | {0xDF: "ss", 0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None, 0xFEFF: None}
_MARKS = re.compile(r"[0-9@$!|]")
_REST = re.compile(r"[\w@$!|]*")
_PLAIN = str.maketrans(DIGITS[0] + SIGNS[0], DIGITS[1] + SIGNS[1])
_SECOND = str.maketrans(SECOND_DIGITS[0] + SIGNS[0], SECOND_DIGITS[1] + SIGNS[1])
_AMBIGUOUS = re.compile(r"[1269]")
_LETTER = re.compile(r"[^\W\d_]")


def _accents() -> dict[int, str]:
    """Latin letters with marks, and full-width letters, to the plain letter that their decomposition starts with."""
    out = {}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(c))[0].lower()
        if plain.isascii() and plain.isalpha():
            out[c] = plain
    return out


_TABLE = _accents() | _TABLE | {c: None for c in range(0x300, 0x370)}


def _unmask(text: str, letters: dict[int, int]) -> str:
    """Digits and signs that stand for letters, in every word that has both; signs at a word's end stay."""
    out, at = [], 0
    for m in _MARKS.finditer(text):
        start = m.start()
        if start < at:
            continue
        while start > at and text[start - 1].isalnum():
            start -= 1
        end = _REST.match(text, m.end()).end()
        word = text[start:end]
        body = word.rstrip("@$!|")
        if _LETTER.search(body):
            word = body.translate(letters) + word[len(body) :]
        out += [text[at:start], word]
        at = end
    return "".join(out) + text[at:] if out else text


def fold(text: str) -> str:
    """Text as the lexicon sees it. Numbers stay; signs at a word's end stay; invisible characters go."""
    return _unmask(_lowered(text), _PLAIN)


def _lowered(text: str) -> str:
    text = text.lower()
    return text if text.isascii() else text.translate(_TABLE)


def readings(text: str) -> list[str]:
    """The folded text, and its second reading where a digit may stand for another letter. Both are equally long."""
    lowered = _lowered(text)
    first = _unmask(lowered, _PLAIN)
    if not _AMBIGUOUS.search(lowered):
        return [first]
    second = _unmask(lowered, _SECOND)
    return [first] if second == first else [first, second]


def _words(folded: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", folded)


class Lexicon:
    """``terms``: word beginnings with weights. ``curve``: bias, slope of the hits, slope of the hits by length."""

    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...], curve: tuple[float, float, float]):
        self.terms, self.exceptions, self.curve = terms, exceptions, curve

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for t, w in self.terms.items():
            a.add_word(t, (len(t), w, True))
        for e in self.exceptions:
            e = fold(e)
            a.add_word(e, (len(e), 0.0, False))
        if len(a):
            a.make_automaton()
        return a


def hits(a: ahocorasick.Automaton, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the terms at word beginnings outside exception phrases; of nested hits the longest counts."""
    best: dict[int, tuple[int, float]] = {}
    spared = []
    if not len(a):
        return []
    for last, (n, weight, counts) in a.iter(folded):
        start = last - n + 1
        if start and folded[start - 1].isalpha():
            continue
        if not counts:
            if last + 1 >= len(folded) or not folded[last + 1].isalpha():
                spared.append((start, last))
        elif start not in best or best[start][0] < last:
            best[start] = (last, weight)
    return [(s, e + 1, w) for s, (e, w) in sorted(best.items()) if not any(x <= s and e <= y for x, y in spared)]


def measures(a: ahocorasick.Automaton, text: str) -> tuple[float, float]:
    """Weighted hits, and weighted hits by length in words, both on a logarithmic scale."""
    read = readings(text)
    folded = read[0]
    found = {s: w for r in reversed(read) for s, _, w in hits(a, r)}
    weight = sum(found.values())
    return math.log1p(max(weight, 0.0)), math.log1p(100 * max(weight, 0.0) / max(LENGTH_FLOOR, folded.count(" ") + 1))


def _ratio(a: int, b: int, n1: int, n0: int) -> float:
    """Likelihood ratio of a term in ``a`` of ``n1`` toxic and ``b`` of ``n0`` other rows."""
    out = 0.0
    for k, n in ((a, n1), (b, n0)):
        p, q = k / n, (a + b) / (n1 + n0)
        out += (k * math.log(p / q) if k else 0) + ((n - k) * math.log((1 - p) / (1 - q)) if k < n else 0)
    return 2 * out


def learn_terms(texts: list[str], labels: list[int]) -> dict[str, float]:
    """Word beginnings that mark toxic rows, chosen greedily: each must explain rows that those before it do not.

    So words that merely sit in a much-copied toxic text add nothing once its telling word is found.
    """
    n1 = sum(labels)
    n0 = len(labels) - n1
    terms = {s: SEED_WEIGHT for s in SEEDS}
    if not n1 or not n0:
        return terms
    words = [set(_words(fold(t))) for t in texts]
    starts = [{w[:k] for w in ws for k in range(SHORTEST, min(LONGEST, len(w)) + 1)} if y else None for ws, y in zip(words, labels, strict=True)]
    counts = (Counter(), Counter(t for s in starts if s for t in s))
    counts[1].subtract({t: a for t, a in counts[1].items() if a < SUPPORT})
    counts = (counts[0], +counts[1])
    for ws, y in zip(words, labels, strict=True):
        if not y:
            counts[0].update({t for w in ws for k in range(SHORTEST, min(LONGEST, len(w)) + 1) if (t := w[:k]) in counts[1]})
    telling = {t for t, a in counts[1].items() if a >= SUPPORT and a * n0 > 3 * counts[0][t] * n1 and _ratio(a, counts[0][t], n1, n0) >= G2}
    where = defaultdict(set)
    for i, own in enumerate(starts):
        for t in (own or set()) & telling:
            where[t].add(i)
    weight = {t: math.log((counts[1][t] + 0.5) / (n1 + 1)) - math.log((counts[0][t] + 0.5) / (n0 + 1)) for t in telling}
    for s in SEEDS:
        if s in weight:
            terms[s] = max(weight[s], 1.0)
    explained = set().union(*(where[s] for s in SEEDS if s in where))
    while telling:
        gain = {t: len(where[t] - explained) * min(weight[t], 3.0) for t in telling}
        most = max(gain.values())
        t = min((x for x in telling if gain[x] >= most), key=lambda x: (-len(x), x))
        if len(where[t] - explained) < SUPPORT:
            break
        terms[t] = weight[t]
        explained |= where[t]
        telling.discard(t)
    return terms


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge."""
    z = np.column_stack((np.ones(len(x)), x))
    beta = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)) if len(y) else -2.0, 0.0, 0.0])
    for _ in range(30 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(3), z.T @ (y - p) - 0.1 * beta * [0, 1, 1])
        beta += np.clip(step, -2, 2)
    return float(beta[0]), float(beta[1]), float(beta[2])


def learn(texts: list[str], labels: list[int], exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and curve from labelled texts; without both classes the seed terms with a plain curve."""
    terms = learn_terms(texts, labels)
    if len(set(labels)) < 2:
        return Lexicon(terms, exceptions, (-2.0, 1.5, 0.5))
    a = Lexicon(terms, exceptions, (0, 0, 0)).automaton()
    x = np.array([measures(a, t) for t in texts])
    return Lexicon(terms, exceptions, calibrate(x, np.array(labels, float)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    rows = tables.labelled(docs, labels, "toxic", max_rows).orderBy("doc_id", "text").collect()
    return learn([r["text"] for r in rows], [r["label"] for r in rows], exceptions)


def score(text: Column, lexicon: Lexicon) -> Column:
    """Score of every text, 0 to 1, over its whole length; null and empty texts have no hits."""
    terms, exceptions, (bias, slope, rate) = lexicon.terms, lexicon.exceptions, lexicon.curve

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = Lexicon(terms, exceptions, (bias, slope, rate)).automaton()
        for texts in batches:
            x = np.array([measures(a, t) for t in texts]).reshape(-1, 2)
            yield pd.Series(1 / (1 + np.exp(-np.clip(bias + x @ [slope, rate], -40, 40))), dtype="float64")

    return run(F.coalesce(text, F.lit("")))


def spans(text: str, lexicon: Lexicon) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the hits in the folded text; for reports on single texts."""
    return hits(lexicon.automaton(), fold(text))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels of the held-out fold are never seen; language, source and id are never inputs. Null texts count as empty, null ids
    as held out, repeated rows each get a row; other columns are not read; an empty table gives an empty result. Nothing
    but the bounded training sample is exchanged.
    """
    lexicon = fit(docs, labels, max_rows)
    scored = docs.select("doc_id", tables.held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
