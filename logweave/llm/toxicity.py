"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import text_blocks, with_ids

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "α": "a", "ο": "o",
    "ρ": "p", "ν": "v", "τ": "t", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

# labelled documents of each label that the lexicon is learned from
SAMPLE = 6_000
# lengths of word beginnings that may become terms, and how often a term must occur in toxic texts
BEGINNINGS, LEAST = (4, 5, 6, 7, 8), 5
STRENGTH = 4.3  # log odds from which a term is kept
THRESHOLD = 0.3

_table = str.maketrans({**LOOKALIKES, **{c: None for c in "​‌‍⁠­﻿"}})
_between = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])|(?<![^\W_])[013457@$]+(?=[^\W\d_]{2})")
_spaces = re.compile(r"[^\w]+|_+")


def fold(text: str) -> str:
    """Lower case words between single blanks, look-alikes and digits inside words turned into letters."""
    text = unicodedata.normalize("NFKC", text).lower().translate(_table)
    text = _between.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)
    return " " + _spaces.sub(" ", text).strip() + " "


def terms_of(folded: str) -> set[str]:
    """Words and beginnings of words, as they stand behind a blank."""
    words = set(folded.split())
    out = {f" {w} " for w in words}
    for size in BEGINNINGS:
        out.update(f" {w[:size]}" for w in words if len(w) >= size)
    return out


class Lexicon:
    """Weighted terms, and phrases in which they don't count, in one automaton."""

    def __init__(self, weights: dict[str, float], exceptions: set[str], bias: float, slope: float):
        self.weights, self.exceptions, self.bias, self.slope = weights, exceptions, bias, slope
        self._build()

    def _build(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for term in {*self.weights, *self.exceptions}:
            self.automaton.add_word(term, (len(term), self.weights.get(term, 0.0), term in self.exceptions))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.bias, self.slope)

    def score(self, text: str) -> float:
        """Between 0 and 1: the weight of all hits outside exceptions, against the logarithm of the length."""
        folded = fold(text)
        spans, hits = [], []
        if len(self.automaton):
            for last, (size, weight, spare) in self.automaton.iter(folded):
                (spans if spare else hits).append((last - size + 1, last, weight))
        best: dict[int, float] = defaultdict(float)  # a word counts once, by its heaviest term
        # exceptions by start, with the furthest end of all up to there
        spans.sort()
        begins, ends = [a for a, _, _ in spans], list(accumulate((b for _, b, _ in spans), max))
        for start, last, weight in hits:
            at = bisect_right(begins, start)
            if not at or ends[at - 1] < last:
                best[start] = max(best[start], weight)
        level = sum(best.values()) / math.log2(4 + folded.count(" "))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * level))))


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from ``doc_id, text`` and ``doc_id, toxic``; nulls and ids without a text are passed over.

    Learns from ``sample`` documents of each label at most, those with the smallest hashes of their ids, and from
    equal texts once. A term is a word or the beginning of one. It is kept for its smoothed log
    odds between toxic and other texts, the shortest beginning with about the odds of longer ones for all. A
    kept term in a pair of words that other texts mostly have is an exception there. Bias and
    slope are fitted to the sample by a few Newton steps, at the share of labels in it reweighed to even.
    """
    known = labels.filter("doc_id is not null and toxic is not null").select("doc_id", "toxic")
    chosen = [
        known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for label in (0, 1)
    ]
    picked = chosen[0].union(chosen[1]).dropDuplicates(["doc_id"])
    texts = (
        with_ids(docs.filter("text is not null").select("doc_id", "text"), picked.select("doc_id"), "doc_id")
        .join(F.broadcast(picked), "doc_id")
        .groupBy(F.md5("text").alias("digest"))
        .agg(F.min_by("text", "doc_id").alias("text"), F.max("toxic").alias("toxic"))
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(block.column("text").to_pylist(), block.column("toxic").to_pylist(), strict=True):
                for term in terms_of(fold(text)):
                    counts[term][toxic] += 1
            yield pa.RecordBatch.from_pydict(
                {"term": list(counts), "clean": [c[0] for c in counts.values()], "toxic": [c[1] for c in counts.values()]}
            )

    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon({}, set(), -3.0, 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    strong = (
        texts.mapInArrow(extract, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("odds", odds)
        .filter((F.col("toxic") >= LEAST) & (F.col("odds") >= STRENGTH))
    )
    rows = {r["term"]: r for r in strong.collect()}  # terms of a bounded sample
    weights = {}
    for term in sorted(rows, key=len):
        shorter = [term[:n] for n in range(2, len(term)) if term[:n] in weights]
        if not any(weights[s] >= rows[term]["odds"] - 1 for s in shorter):
            weights[term] = rows[term]["odds"]

    # pairs of words around hits, and the levels that the fit needs
    plain = Lexicon(weights, set(), 0.0, 1.0)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = [t for t in weights]
        for block in text_blocks(batches):
            phrases, flags = [], []
            for text, toxic in zip(block.column("text").to_pylist(), block.column("toxic").to_pylist(), strict=True):
                words = fold(text).split()
                hit = [any(f" {w} ".startswith(t) for t in heads) for w in words]
                found = {f" {a} {b} " for (a, x), (b, y) in zip(zip(words, hit), zip(words[1:], hit[1:]), strict=False) if x or y}
                phrases += found
                flags += [toxic] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(flags, pa.int64())], ["phrase", "toxic"])

    mostly_clean = (
        texts.mapInArrow(neighbours, "phrase string, toxic long")
        .groupBy("phrase")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
        .filter(f"n >= {LEAST} and toxic < 0.1 * n")
    )
    exceptions = {r["phrase"] for r in mostly_clean.collect()}
    plain = Lexicon(weights, exceptions, 0.0, 1.0)

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            scores = [plain.score(text) for text in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), block.column("toxic")], ["score", "toxic"])

    fit = texts.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(levels, "score double, toxic long").toArrow()
    score = np.clip(fit.column("score").to_numpy(), 1e-12, 1 - 1e-12)
    level, toxic = np.log(score / (1 - score)), fit.column("toxic").to_numpy().astype(float)
    return Lexicon(weights, exceptions, *_logistic(level, toxic))


def _logistic(level: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve, with the two labels weighted alike and a weak pull to zero."""
    share = np.where(toxic > 0, 0.5 / max(toxic.sum(), 1), 0.5 / max((1 - toxic).sum(), 1)) * len(toxic)
    x, beta = np.stack([np.ones_like(level), level], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (share * (toxic - p)) - 0.5 * beta
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        beta = beta + np.linalg.solve(bend, slope)
    return float(beta[0]), float(beta[1])


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text. Null and empty texts have no hits; ids are kept as they are."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            scores = [lexicon.score(text or "") for text in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
