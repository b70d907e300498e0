"""Language identification with interpolated Kneser-Ney character models.

Learning counts character 4-grams of every labelled row: each task sums its own rows, and
Spark sums the partial counts by (language, gram), so what is gathered follows the
corpus. Lower orders are continuation counts, which follow from the distinct grams. No gram is
cut: the models, sorted arrays of all grams with their discounted probabilities, grow with
the distinct grams of the corpus and travel with the tasks (under ``MAX_LANGUAGES`` languages, or
learning fails). Driver and tasks hold them whole.

Prediction scores whole texts: the language of the lowest cross-entropy per character. A
direct-mapped table remembers the probabilities of recent grams.

Rejection is calibrated on all labelled rows: per language the median and spread (median absolute
deviation) of the cross-entropy, by grouped aggregates; a language with fewer than ``ENOUGH`` rows
in the whole table takes those over all languages. A text is accepted if its own does not exceed the median by
more than ``TOLERANCE`` standard errors (spread between texts plus sampling error of a text of
this length). ``score`` is the posterior of the language, tempered by text length.

Defined results: null text or one without a letter gives ``und``, score 0, not accepted; ties go
to the first language in sorted order; with no labelled row every text is ``und``. Rows with a
null id are scored but never learned from; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import staged
from formlake.llm.textkit import small_batches

ORDER = 4
MAX_LANGUAGES = 500
ENOUGH = 20
TOLERANCE = 8.0
UNKNOWN = "und"
_CHUNK = 500_000  # characters handled at once
_U = np.uint64
_EDGE = "\0" * (ORDER - 1)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def characters(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram ending at each character, document of it, documents with a letter).

    Texts are lower-cased; runs of other than letters are one space; every text is padded
    with edge marks.
    """
    joined = _EDGE + _EDGE.join(texts) + _EDGE
    if joined.count("\0") != len(_EDGE) * (len(texts) + 1):
        joined = _EDGE + _EDGE.join(t.replace("\0", " ") for t in texts) + _EDGE
    code = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    edge = code == 0
    if code.max(initial=0) > 0xFFFF:
        wide = code > 0xFFFF
        letter = letters[np.where(wide, 0, code)]
        letter[wide] = [chr(c).isalpha() for c in code[wide]]
        code = np.where(wide, 0xE000 + (code & 0x7FF), code)  # folded into the private use area
    else:
        letter = letters[code]
    code = np.where(edge, 0, np.where(letter, code, 32)).astype(np.uint64)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
    code, edge, letter = code[keep], edge[keep], letter[keep]
    doc = np.cumsum(edge) // len(_EDGE) - 1
    grams = code.copy()
    for back in range(1, ORDER):
        grams[back:] |= code[:-back] << _U(16 * back)
    inside = ~edge
    return grams[inside], doc[inside], np.bincount(doc[inside], weights=letter[inside], minlength=len(texts)) > 0


def _text_chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``labelled`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = _letters(), {}
        for batch in small_batches(batches, "text"):
            langs, texts = np.array(batch.column("lang").to_pylist(), dtype=object), batch.column("text").to_pylist()
            for i, j in _text_chunks(texts):
                grams, doc, _ = characters(texts[i:j], letters)
                for lang in set(langs[i:j]):
                    own = grams[np.isin(doc, np.flatnonzero(langs[i:j] == lang))] if len(set(langs[i:j])) > 1 else grams
                    g, n = np.unique(own, return_counts=True)
                    if lang in sums:
                        g, n = np.concatenate([sums[lang][0], g]), np.concatenate([sums[lang][1], n])
                        order = np.argsort(g, kind="stable")
                        first = np.flatnonzero(np.concatenate([[True], np.diff(g[order]) != 0])) if len(g) else np.zeros(0, int)
                        g, n = g[order][first], np.add.reduceat(n[order], first) if len(first) else n
                    sums[lang] = (g, n)
                    if len(g) > 2_000_000:  # bounded memory: hand the partial sums on
                        yield _count_batch(lang, *sums.pop(lang))
        for lang, (g, n) in sums.items():
            yield _count_batch(lang, g, n)

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _count_batch(lang: str, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


class KneserNey:
    """Sorted hash arrays of one language: per order, grams with their discounted shares and
    contexts with the weight of the next lower order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        order = np.argsort(grams)
        g, c = grams[order], counts[order].astype(np.float64)
        self.base, self.orders = 1.0 / alphabet, []
        for size in range(ORDER, 0, -1):
            once, twice = float(np.sum(c == 1)), float(np.sum(c == 2))
            discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
            contexts, of = np.unique(g >> _U(16), return_inverse=True)
            total = np.bincount(of, weights=c)
            self.orders.append((g, (c - discount) / total[of], contexts, discount * np.bincount(of) / total))
            g, c = np.unique(g & _U((1 << 16 * (size - 1)) - 1), return_counts=True)
            c = c.astype(np.float64)
        self.orders.reverse()

    def logp(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), self.base)
        for size, (keys, share, contexts, weight) in enumerate(self.orders, 1):
            own = grams & _U((1 << 16 * size) - 1)
            p *= _lookup(contexts, weight, own >> _U(16), 1.0)
            p += _lookup(keys, share, own, 0.0)
        return np.log(p)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


class Scorer:
    """Sums of log probabilities per text and language."""

    SLOTS = 18

    def __init__(self, models: list[KneserNey]):
        self.models, self.letters = models, _letters()
        self.keys = np.full(1 << self.SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.values = np.zeros((1 << self.SLOTS, len(models)), dtype=np.float32)

    def per_gram(self, grams: np.ndarray) -> np.ndarray:
        slot = (grams * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.SLOTS)
        missing = self.keys[slot] != grams
        if missing.any():
            new = np.unique(grams[missing])
            at = (new * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.SLOTS)
            logp = np.stack([m.logp(new) for m in self.models], axis=1).astype(np.float32)
            self.keys[at], self.values[at] = new, logp
            out = self.values[slot]
            lost = np.flatnonzero(self.keys[slot] != grams)  # two grams on one slot
            if len(lost):
                out[lost] = logp[np.searchsorted(new, grams[lost])] if np.isin(grams[lost], new).all() else np.stack([m.logp(grams[lost]) for m in self.models], axis=1)
            return out
        return self.values[slot]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(characters, has a letter, log probability sums, sums of squares) per text."""
        n, letter = np.zeros(len(texts)), np.zeros(len(texts), bool)
        sums, squares = np.zeros((len(texts), len(self.models))), np.zeros((len(texts), len(self.models)))
        for i, j in _text_chunks(texts):
            grams, doc, letter[i:j] = characters(texts[i:j], self.letters)
            if not len(grams):
                continue
            logp = self.per_gram(grams)
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            who = i + doc[first]
            n[who] = np.diff(np.append(first, len(doc)))
            sums[who] = np.add.reduceat(logp, first, axis=0, dtype=np.float64)
            squares[who] = np.add.reduceat(logp * logp, first, axis=0, dtype=np.float64)
        return n, letter, sums, squares


def _scored(rows: DataFrame, models: list[KneserNey], langs: list[str], text: str) -> DataFrame:
    """``rows`` (less a column ``text``) with lang_pred, score, letter (it has one), entropy, error (of the entropy) and n (characters scored)."""
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models) if models else None
        for batch in small_batches(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            size = len(texts)
            pred, score, letter, entropy, error = np.full(size, UNKNOWN, dtype=object), np.zeros(size), np.zeros(size, bool), np.zeros(size), np.zeros(size)
            n = np.zeros(size)
            if scorer:
                n, letter, sums, squares = scorer(texts)
                safe = np.maximum(n, 1)[:, None]
                best = np.argmax(sums, axis=1)
                at = (np.arange(size), best)
                mean = sums[at] / safe[:, 0]
                entropy = -mean
                error = np.sqrt(np.maximum(squares[at] / safe[:, 0] - mean * mean, 1e-6) / safe[:, 0])
                # neighbouring characters are not independent: the evidence is tempered
                posterior = 1 / np.exp((sums - sums[at][:, None]) / ORDER).sum(axis=1)
                pred[letter] = np.array(langs, dtype=object)[best[letter]]
                score = np.where(letter, posterior, 0.0)
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(letter), pa.array(entropy), pa.array(error), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "lang_pred", "score", "letter", "entropy", "error", "n"])

    fields = [f"{c} {t}" for c, t in rows.select(*keep).dtypes]
    return rows.mapInArrow(run, ", ".join(fields) + ", lang_pred string, score double, letter boolean, entropy double, error double, n long")


def limits_of(seen: DataFrame) -> DataFrame:
    """(lang, mean, spread) of ``seen`` (lang, entropy): all rows count; a language of few rows has the limits over all."""
    middle = lambda x: F.percentile_approx(x, 0.5, 10_000)
    means = seen.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), middle(F.col("entropy")).alias("mean"))
    off = seen.join(F.broadcast(means), "lang").groupBy("lang").agg(F.first("rows").alias("rows"), F.first("mean").alias("mean"), middle(F.abs(F.col("entropy") - F.col("mean"))).alias("off"))
    every = seen.agg(middle(F.col("entropy")).alias("mean"))
    every = seen.crossJoin(F.broadcast(every)).agg(F.first("mean").alias("all_mean"), middle(F.abs(F.col("entropy") - F.col("mean"))).alias("all_off"))
    enough = F.col("rows") >= ENOUGH
    pick = lambda c: F.when(enough, F.col(c)).otherwise(F.col(f"all_{c}"))
    return off.crossJoin(F.broadcast(every)).select("lang", pick("mean").alias("mean"), F.greatest(F.lit(0.02), 1.4826 * pick("off")).alias("spread"))



def learn(labelled: DataFrame, label: str = "language") -> tuple[list[KneserNey], list[str]]:
    """Models and their languages from ``labelled`` (lang, text; no nulls)."""
    counts = staged(gram_counts(labelled), f"{label}-grams")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; at most {MAX_LANGUAGES} models travel with the tasks")
    models = []
    for lang in langs:  # one language at a time goes through the driver
        own = counts.filter(F.col("lang") == lang).select("gram", "n").toPandas()
        grams, n = own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy()
        models.append(KneserNey(grams, n, len(np.unique(grams & _U(0xFFFF))) + 1))
    return models, langs


def identify(docs: DataFrame, train: Column | None = None, keep: tuple[str, ...] = ("doc_id",), prefix: str = "") -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, lang); learns from rows with a language
    for which ``train`` holds (all of them by default). ``keep``: columns to pass through;
    ``prefix``: before the names of the new ones."""
    known = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    if train is not None:
        known = known & train
    own = F.when(known, F.col("lang").cast("string")).alias("lang")
    models, langs = learn(docs.filter(known).select(own, "text"))
    # kept columns by place: one may have a name used here
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    text = f"k{keep.index('text')}" if "text" in keep else "text"
    rows = docs.select(*kept, own, *([] if "text" in keep else ["text"]))
    # one pass: scored rows are written, limits follow from all labelled ones among them
    scored = staged(_scored(rows, models, langs, text), "language-scored")
    limits = limits_of(scored.filter("lang is not null and n > 0").select("lang", "entropy")).withColumnRenamed("lang", "lang_pred")
    fits = F.col("entropy") - F.col("mean") <= TOLERANCE * F.sqrt(F.col("spread") * F.col("spread") + F.col("error") * F.col("error"))
    judged = scored.join(F.broadcast(limits), "lang_pred", "left").withColumn("accepted", F.col("letter") & F.coalesce(fits, F.lit(False)))
    return judged.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(c).alias(prefix + c) for c in ("lang_pred", "score", "accepted", "entropy", "n")])


def accept_languages(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is rejected."""
    kept = identify(docs, keep=tuple(docs.columns), prefix="__").filter("__accepted")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
