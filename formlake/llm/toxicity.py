"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the words of a text and their stems (first bytes of longer words) is fitted with numpy from confirmed toxic examples and
unlabelled texts. With class prior p the risk is
``p R(toxic as 1) + max(0, R(unlabelled as 0) - p R(toxic as 0))``: unlabelled texts stand for
both classes, the subtracted term takes their toxic share out, and where the corrected
part turns negative the step goes back on it alone. The prior is the toxic share of the labelled
training rows.

The fit uses a bounded sample: about ``POSITIVE`` toxic and ``UNLABELLED`` other rows, chosen by a
hash and written. Features are the ``FEATURES`` words most overrepresented in toxic texts (by likelihood ratio, equal ones by hash), found in
``LEAST`` sampled texts or more; Spark counts the texts of every word. The driver gathers the chosen words and, per sampled
text, the numbers of those it has: at most ``FEATURES`` two-byte numbers a text, however long texts are. Scoring covers every
row and whole texts: tasks hold the model (at most ``FEATURES`` hashed words) and read texts once.

Words are runs of letters, digits and bytes over 127, A-Z lower-cased; each counts once a text.
Defined results: a null or empty text has no words and scores the model's intercept; with no
toxic training row every score is 0; equal texts score alike; label rows with null ids or
values are left out, repeated label rows count once; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import delete_staged, hash_sample, staged
from formlake.llm.textkit import _LOWER, Rolling, chunks, column_bytes, mix, signed, small_batches, word_spans

POSITIVE = 4_000
UNLABELLED = 12_000
LEAST = 8
FEATURES = 3_000  # under 32,768
GAIN = 10.0  # a smaller likelihood gain of a feature is taken for chance
STEMS = (5, 6, 7)  # bytes
STEPS = 150
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last, hashes of words and stems, document of each) by chunk of documents."""
    for i, j in chunks(offsets):
        own = offsets[i : j + 1] - offsets[i]
        part = _LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, first = word_spans(part, own, _OUTSIDE)
        doc, rolling = np.repeat(np.arange(i, j), np.diff(first)), Rolling(part)
        hashes, docs = [rolling(starts, ends)], [doc]
        for size in STEMS:
            longer = ends - starts > size
            hashes.append(mix(rolling(starts[longer], starts[longer] + size)))
            docs.append(doc[longer])
        yield i, j, np.concatenate(hashes), np.concatenate(docs)


def _word_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(toxic of each text, word hashes, text of each) of the distinct words of texts, by chunk of texts (toxic, text)."""
    for batch in small_batches(batches, "text"):
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for i, j, hashes, doc in word_sets(*column_bytes(batch.column("text"))):
            order = np.lexsort((hashes, doc))
            hashes, doc = hashes[order], doc[order]
            keep = np.ones(len(doc), dtype=bool)
            keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            yield toxic[i:j], hashes[keep], doc[keep] - i


def word_gains(sample: DataFrame) -> DataFrame:
    """(word, gain) of the words of ``sample`` (toxic boolean, text) that are features by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for toxic, hashes, doc in _word_texts(batches):
            for kind in (True, False):
                own = toxic[doc] == kind
                words, n = np.unique(hashes[own], return_counts=True)
                # texts with a word are counted under no word
                arrays = [pa.array([None, *signed(words).tolist()], pa.int64()), pa.array(np.append(len(np.unique(doc[own])), n))]
                yield pa.RecordBatch.from_arrays([pa.array([kind] * (len(words) + 1)), *arrays], names=["toxic", "word", "n"])

    counts = sample.mapInArrow(run, "toxic boolean, word long, n long")
    both = lambda of: [F.sum(F.when(F.col("toxic") == kind, F.col("n")).otherwise(0)).alias(name) for kind, name in zip((True, False), of)]
    counts = staged(counts.groupBy("word").agg(*both(("here", "there"))), "toxicity-words")
    all_here, all_there = counts.filter("word is null").select("here", "there").first() or (0, 0)
    found = counts.filter((F.col("here") + F.col("there") >= LEAST) & (F.col("here") >= 2) & F.col("word").isNotNull())
    found = found.filter(F.col("here") * all_there >= F.col("there") * all_here)
    share = (F.col("here") + F.col("there")) / max(1, all_here + all_there)
    term = lambda n, of: F.col(n) * F.log(F.greatest(F.col(n), F.lit(1)) / (share * max(1, of)))
    return found.select("word", (term("here", all_here) + term("there", all_there)).alias("gain")).filter(F.col("gain") >= GAIN)


def chosen_words(sample: DataFrame, features: int = FEATURES) -> np.ndarray:
    """The sorted hashes of the at most ``features`` words of the greatest gain."""
    rows = word_gains(sample).orderBy(F.desc("gain"), "word").limit(features).select("word").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def coded(sample: DataFrame, words: np.ndarray) -> DataFrame:
    """(toxic, codes: places in ``words`` of the words of the text) of the texts of ``sample`` with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for toxic, hashes, doc in _word_texts(batches):
            at = np.minimum(np.searchsorted(words, hashes), max(0, len(words) - 1))
            hit = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
            some = np.unique(doc)
            sizes = np.bincount(doc[hit], minlength=len(toxic))[some]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            codes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at[hit].astype(np.int16)))
            yield pa.RecordBatch.from_arrays([pa.array(toxic[some].astype(bool)), codes], names=["toxic", "codes"])

    return sample.mapInArrow(run, "toxic boolean, codes array<short>")


class Model:
    """Sorted word hashes, their weights and the intercept."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, intercept: float):
        self.words, self.weights, self.intercept = words, weights, intercept

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = np.full(len(offsets) - 1, self.intercept)
        for i, j, hashes, doc in word_sets(data, offsets):
            if not len(hashes) or not len(self.words):
                continue
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            seen = np.unique((doc[hit] - i) * len(self.words) + at[hit])
            z[i:j] += np.bincount(seen // len(self.words), weights=self.weights[seen % len(self.words)], minlength=j - i)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _gathered(found: pa.Table, toxic: bool) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of texts, their codes) of one kind."""
    codes = found.filter(pa.compute.equal(found.column("toxic"), toxic)).column("codes").combine_chunks()
    codes = pa.concat_arrays(codes.chunks) if isinstance(codes, pa.ChunkedArray) and codes.num_chunks else codes
    if not len(codes):
        return np.zeros(1, np.int64), np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(codes.value_lengths().to_numpy())]), codes.flatten().to_numpy().astype(np.int64)


def fit(words: np.ndarray, positive, unlabelled, prior: float, steps: int = STEPS, rate: float = 0.05, decay: float = 2e-4) -> Model:
    """Full-batch Adam on the non-negative risk with logistic loss; both kinds are (offsets of texts, places in ``words``)."""
    (po, pc), (uo, uc) = positive, unlabelled
    if len(po) < 2 or len(uo) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -500.0 if len(po) < 2 else 0.0)
    n_p, n_u = len(po) - 1, len(uo) - 1
    code = np.concatenate([pc, uc])
    rows = np.concatenate([np.repeat(np.arange(n_p), np.diff(po)), n_p + np.repeat(np.arange(n_u), np.diff(uo))])
    # a word's say is measured against its rarity, and a long text's against its length
    w, b = np.zeros(len(words)), np.log(prior / (1 - prior))
    first, second, at = np.zeros(len(words) + 1), np.zeros(len(words) + 1), 0
    for at in range(1, steps + 1):
        z = np.bincount(rows, weights=w[code], minlength=n_p + n_u) + b
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        # derivatives by z of log loss: as 1 it is p - 1, as 0 it is p
        loss0 = np.logaddexp(0, z)
        corrected = loss0[n_p:].mean() - prior * loss0[:n_p].mean()
        as_zero = np.concatenate([-prior * p[:n_p] / n_p, p[n_p:] / n_u])
        if corrected >= 0:
            g = as_zero
            g[:n_p] += prior * (p[:n_p] - 1) / n_p
        else:
            g = -as_zero
        grad = np.append(np.bincount(code, weights=g[rows], minlength=len(words)) + decay * w, g.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        step = rate * (first / (1 - 0.9**at)) / (np.sqrt(second / (1 - 0.999**at)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    return Model(words, w, float(b))


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text); learns from rows of ``docs``
    and ``labels`` (doc_id, toxic) for which ``train``, a condition on doc_id, holds."""
    train = F.lit(True) if train is None else train
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train).distinct()
    rated = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    prior = min(0.95, max(1e-3, rated or 0.0))
    toxic = hash_sample(known.filter("toxic = 1").select("doc_id").distinct(), POSITIVE)
    pool = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull() & train)
    # the sample of toxic ids holds about POSITIVE rows, whatever the size of the tables
    confirmed = pool.join(F.broadcast(toxic), "doc_id", "left_semi").select(F.lit(True).alias("toxic"), "text")
    sample = staged(confirmed.unionByName(hash_sample(pool, UNLABELLED).select(F.lit(False).alias("toxic"), "text")), "toxicity-sample")
    words = chosen_words(sample)
    found = coded(sample, words).toArrow()
    delete_staged(sample)
    model = fit(words, _gathered(found, True), _gathered(found, False), prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            score = model.scores(*column_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, score double, predicted int")
