"""Problem 10: reading level of each document.

A Rasch-style latent model puts documents and words on one scale: the log odds
that an occurrence in document d is word w (and not another word) are linear in
the document's level, ``psi_w + beta_w * t_d``, a multinomial logit with an easiness
psi_w and a discrimination beta_w; words of demanding prose have positive
ones.  A document's length is its exposure, and words that are absent count
through the normaliser over the whole vocabulary.  The likelihood is maximised
by alternating optimisation: given the levels, each word's Newton steps need two
sums over its documents and the histogram of levels; given the words, each
document's level needs two sums over its words and the normaliser on a grid.
Graded documents hold their (median) grade while words are estimated; the
alternation ends when the mean log-likelihood of an occurrence changes by less
than ``REST``.  Every document's final level, graded ones' too, comes from its
words, and is brought to the scale of the grades by the four cuts that separate
the graded documents with fewest errors.

Only prose counts: runs of at least four words within a sentence, after markup,
invisible characters and compatibility forms are taken away.  A document
without prose has no level and is no row of the result; so have null, empty and
blank texts.  Without any usable grade the result has no rows.  Rows with null
``doc_id`` are left out; rows of one ``doc_id`` are one document, whose words add up.
"""

from __future__ import annotations

import html
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import BROADCAST_ROWS, checked_side, checkpointed

#: Relative change of the log-likelihood at which the alternation ends, and a guard far above what it needs.
REST, MOST_ROUNDS = 1e-2, 50
#: Prior documents of a word at the mean level, and precision of the prior of a discrimination.
PRIOR, PRECISION = 1.0, 0.5
#: Grid of latent levels around the middle grade, and steps of a level in the calibration.
GRID, MIDDLE, STEPS = np.linspace(-3.0, 3.0, 121), 3.0, 100
#: Demanding are levels 4 and 5.
DEMANDING = 3.5
CUTS = (1.5, 2.5, 3.5, 4.5)


def _patterns():
    import regex

    return (
        regex.compile(r"[­​-‏⁠﻿]"),
        regex.compile(r"</?[a-zA-Z!][^<>]*>"),
        regex.compile(r"[\r\n|]+|(?<=[.!?])\s"),
        regex.compile(r"\p{L}[\p{L}\p{M}'’\-]*"),
        regex.compile(r"(?:\p{L}[\p{L}\p{M}'’\-]*[,:;]* +){3}\p{L}"),
    )


def prose_words(text: str | None, patterns=None) -> Counter:
    """Counts of the lower-case words of the text's prose."""
    if not text:
        return Counter()
    hidden, tag, sentence, word, run = patterns or _patterns()
    text = unicodedata.normalize("NFKC", html.unescape(tag.sub(" ", hidden.sub("", text))))
    return Counter(w.lower() for s in sentence.split(text) if run.search(s) for w in word.findall(s))


def word_counts(documents: DataFrame) -> DataFrame:
    """``doc_id, words array<struct<word, c>>`` of the documents with prose; the
    weight of a word is the logarithm of one plus its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                keys, words = [], []
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts = prose_words(t, patterns)
                    if counts:
                        keys.append(k)
                        words.append([{"word": w, "c": math.log1p(n)} for w, n in counts.items()])
                kind = pa.list_(pa.struct([("word", pa.string()), ("c", pa.float64())]))
                yield pa.RecordBatch.from_arrays([pa.array(keys, part.column(0).type), pa.array(words, kind)], ["doc_id", "words"])

    rows = documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, words array<struct<word:string,c:double>>")


def newton(n: np.ndarray, s1: np.ndarray, weights: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Discrimination and easiness of words from their weight and weighted level
    sum; ``weights`` is the share of all occurrences on each point of the grid."""
    share = np.log(weights + 1e-12)
    beta = np.zeros(len(n))
    for _ in range(steps):
        e = share + beta[:, None] * GRID
        q = np.exp(e - e.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        mean = q @ GRID
        step = (s1 - n * mean - PRECISION * beta) / (n * (q @ GRID**2 - mean**2) + PRECISION)
        beta += np.clip(step, -1, 1)
        if np.abs(step).max(initial=0) < 1e-5:
            break
    e = share + beta[:, None] * GRID
    top = e.max(axis=1)
    return beta, np.log(n + PRIOR) - top - np.log(np.exp(e - top[:, None]).sum(axis=1))


def word_parameters(pairs: DataFrame) -> DataFrame:
    """``word, n, beta, psi`` from ``word, c (weight), t (level)``; the sums merge
    map-side, so that a word of every document is no hot key."""
    points = [r for r in pairs.groupBy(grid_point(F.col("t")).alias("k")).agg(F.sum("c").alias("n")).collect()]  # at most as many as the grid has
    weights = np.zeros(len(GRID))
    weights[[r["k"] for r in points]] = [r["n"] for r in points]
    weights /= max(weights.sum(), 1e-12)
    sums = pairs.groupBy("word").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("t")).alias("s1"))

    @F.pandas_udf("beta double, psi double")
    def fitted(n: pd.Series, s1: pd.Series) -> pd.DataFrame:
        beta, psi = newton(n.to_numpy(), s1.to_numpy(), weights)
        return pd.DataFrame({"beta": beta, "psi": psi})

    return sums.select("word", "n", fitted("n", "s1").alias("f")).select("word", "n", "f.beta", "f.psi")


def grid_point(t: Column) -> Column:
    last = len(GRID) - 1
    return F.greatest(F.lit(0), F.least(F.lit(last), F.round((t - float(GRID[0])) / float(GRID[1] - GRID[0])))).cast("int")


def normaliser(words: DataFrame) -> np.ndarray:
    """Logarithm of the sum over the vocabulary of exp(psi + beta t), on the grid."""
    terms = F.transform(F.array(*[F.lit(float(t)) for t in GRID]), lambda t: F.exp(F.col("psi") + F.col("beta") * t))
    sums = words.select(F.posexplode(terms).alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()  # one row a grid point
    out = np.zeros(len(GRID))
    out[[r["k"] for r in sums]] = [r["x"] for r in sums]
    return np.log(out)


def with_parameters(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with ``beta`` and ``psi`` of their word.

    A small vocabulary is broadcast.  Of a large one the frequent words (each
    more than 1 / ``BROADCAST_ROWS`` of all weight, so fewer than that) are, and
    only the pairs of others are shuffled, among which no word is hot."""
    known = words.select("word", "beta", "psi")
    n = words.agg(F.count("*").alias("words"), F.sum("n").alias("n")).first()
    if n["words"] <= BROADCAST_ROWS:
        return pairs.join(F.broadcast(known), "word")
    frequent = F.col("n") > (n["n"] / BROADCAST_ROWS)
    often = F.broadcast(words.filter(frequent).select("word", "beta", "psi"))
    rest = pairs.join(often.select("word"), "word", "left_anti").join(words.filter(~frequent).select("word", "beta", "psi").hint("merge"), "word")
    return pairs.join(often, "word").unionByName(rest)


def levels_of(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``doc_id, raw, fit, size``: level of greatest likelihood, its
    log-likelihood, and the weight of the known words."""
    log_z = normaliser(words)
    q = with_parameters(pairs, words).groupBy("doc_id").agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("beta")).alias("q"), F.sum(F.col("c") * F.col("psi")).alias("r"))

    @F.pandas_udf("raw double, fit double")
    def best(size: pd.Series, q: pd.Series, r: pd.Series) -> pd.DataFrame:
        ll = q.to_numpy()[:, None] * GRID - size.to_numpy()[:, None] * log_z
        top = ll.argmax(axis=1)
        k, at = np.clip(top, 1, len(GRID) - 2), np.arange(len(ll))
        a, b, c = ll[at, k - 1], ll[at, k], ll[at, k + 1]
        bend = a - 2 * b + c
        off = np.where(bend < 0, 0.5 * (a - c) / np.where(bend < 0, bend, 1), 0.0)  # the parabola's top
        raw = np.where(top == k, GRID[k] + np.clip(off, -1, 1) * (GRID[1] - GRID[0]), GRID[top])
        return pd.DataFrame({"raw": raw, "fit": ll[at, top] + r.to_numpy()})

    return q.select("doc_id", "size", best("size", "q", "r").alias("b")).select("doc_id", "b.raw", "b.fit", "size")


def cuts_of(raw: DataFrame, anchors: DataFrame) -> list[float]:
    """Raw levels that part the graded documents at ``CUTS`` with fewest errors;
    from a histogram of bounded size."""
    bins = raw.join(anchors, "doc_id").groupBy(F.round(F.col("raw") * STEPS).cast("int").alias("x"), "grade").agg(F.count("*").alias("n")).collect()
    x = np.array([r["x"] for r in bins])
    grade, n = np.array([r["grade"] for r in bins]), np.array([r["n"] for r in bins])
    values = np.unique(x)
    if not len(values):
        return [c - MIDDLE for c in CUTS]
    out = []
    for cut in CUTS:
        above = np.array([n[(x == v) & (grade > cut)].sum() for v in values])
        below = np.array([n[(x == v) & (grade <= cut)].sum() for v in values])
        errors = np.r_[0, np.cumsum(above)] + below.sum() - np.r_[0, np.cumsum(below)]
        best = np.flatnonzero(errors == errors.min())
        k = best[len(best) // 2]
        ends = values[max(0, k - 1)], values[min(len(values) - 1, k)]
        out.append((ends[0] + ends[1]) / 2 / STEPS)
    return np.maximum.accumulate(out).tolist()


def calibrated(raw: Column, cuts: list[float]) -> Column:
    """Level on the scale of the grades: linear between the cuts, one level a
    unit beyond them, and within half a level of the scale's ends."""
    out = F.lit(CUTS[-1]) + (raw - cuts[-1])
    for k in reversed(range(len(CUTS) - 1)):
        width = cuts[k + 1] - cuts[k]
        inside = F.lit(CUTS[k]) + (raw - cuts[k]) / width if width > 0 else F.lit(CUTS[k])
        out = F.when(raw < cuts[k + 1], inside).otherwise(out)
    out = F.when(raw < cuts[0], F.lit(CUTS[0]) + (raw - cuts[0])).otherwise(out)
    return F.greatest(F.lit(0.5), F.least(F.lit(5.5), out))


def reading_levels(documents: DataFrame, grades: DataFrame, rest: float = REST) -> DataFrame:
    """``doc_id, level``: latent level of each document with prose, on the scale
    of the grades (1 to 5), from its words alone."""
    anchors = grades.filter("doc_id is not null and grade_level between 1 and 5").groupBy("doc_id")
    anchors = checkpointed(anchors.agg(F.percentile("grade_level", F.lit(0.5)).alias("grade")))
    counts = checkpointed(word_counts(documents))
    pairs = lambda df, *more: df.select(*more, F.explode("words").alias("w")).select(*more, "w.word", "w.c")
    if anchors.isEmpty():
        return counts.select("doc_id", F.lit(None).cast("double").alias("level")).limit(0)
    known = checked_side(anchors)
    held, before = known.select("doc_id", (F.col("grade") - MIDDLE).alias("t")), None
    for _ in range(MOST_ROUNDS):
        words = checkpointed(word_parameters(pairs(counts.join(held, "doc_id"), "t")))
        if words.isEmpty():  # no graded document has prose
            return counts.select("doc_id", F.lit(None).cast("double").alias("level")).limit(0)
        raw = checkpointed(levels_of(pairs(counts, "doc_id"), words))
        levels = raw.select("doc_id", calibrated(F.col("raw"), cuts_of(raw, known)).alias("level"))
        total = raw.agg((F.sum("fit") / F.sum("size")).alias("mean")).first()["mean"]
        if before is not None and abs(total - before) <= rest * abs(before):
            break
        before = total
        held = checked_side(levels.join(known, "doc_id", "left").select("doc_id", (F.coalesce("grade", "level") - MIDDLE).alias("t")))
    return levels


def demanding(documents: DataFrame, grades: DataFrame) -> DataFrame:
    """``doc_id`` of the documents on the two most demanding levels."""
    return reading_levels(documents, grades).filter(F.col("level") > DEMANDING).select("doc_id").distinct()
