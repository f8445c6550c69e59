"""Language identification by multilingual mixture inference (operator 3).

Each language is a letter-trigram model (hashed into ``BINS`` bins, smoothed).
A document is a mixture: every word is drawn from one of its languages with
the document's proportions. Expectation-maximisation estimates the
proportions; the language set grows, most probable language first, as long as
the penalised log-likelihood rises (``PENALTY`` / 2 * log(words) for each
language). The answer is the language with the largest proportion.

The models are fitted on a bounded sample: about ``SAMPLE_DOCS`` whole
documents per language, by a hash of doc_id, never of held-out rows.
Prediction is a plain map over every whole text; it reads the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import held_out, map_rows, sampled

SAMPLE_DOCS = 1500
BINS = 1 << 15
PENALTY = 3.0
ROUNDS = 30
SMOOTH = 0.5

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter (none lie beyond plane 3); built once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x32400)), bool, 0x32400))
    return _LETTER[0]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bin of the trigram around each letter, index of each word's first one).

    Words are runs of letters, lower-cased; other signs count as one blank.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()
    code = np.where(letter[np.minimum(code, len(letter) - 1)], code, np.uint32(0))
    padded = np.concatenate([[np.uint32(0)], code, [np.uint32(0)]])
    at = np.flatnonzero(code)
    left, own, right = padded[at], padded[at + 1], padded[at + 2]
    mixed = (left * np.uint32(0x9E3779B1)) ^ (own * np.uint32(0x85EBCA77)) ^ (right * np.uint32(0xC2B2AE3D))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F)
    return (mixed >> np.uint32(17)).astype(np.int64) & (BINS - 1), np.flatnonzero(left == 0)


def _mixture(p: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """EM over word likelihoods ``p`` (words x languages): proportions and
    log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        new = share * (p.T @ (1 / (p @ share))) / len(p)
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, float(np.log(p @ share).sum())


class LanguageModels:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """counts: languages x BINS trigram counts."""
        self.langs, self.counts = langs, counts
        p = (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * BINS)
        self.logp = np.ascontiguousarray(np.log(p).T.astype(np.float32))

    def proportions(self, text: str | None) -> dict[str, float]:
        """The document's languages and their shares; empty without a letter."""
        if not text or not self.langs:
            return {}
        bins, first = trigrams(text)
        if not len(bins):
            return {}
        log = np.concatenate([
            np.add.reduceat(self.logp[bins[a:b]], first[i:j] - a, dtype=np.float64)
            for a, b, i, j in _spans(first, len(bins))
        ])
        # a word counts for no more than exp(-30) under a language it does not fit
        p = np.exp(np.maximum(log - log.max(1, keepdims=True), -30.0))
        order = np.argsort(-_mixture(p, 10)[0], kind="stable") if p.shape[1] > 1 else np.array([0])
        best, kept = -np.inf, {}
        for k in range(1, len(order) + 1):
            share, fit = _mixture(p[:, order[:k]])
            fit -= PENALTY / 2 * k * np.log(len(p) + 1)
            if fit <= best:
                break
            best, kept = fit, {self.langs[l]: float(s) for l, s in zip(order, share)}
        return kept

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """(language, its share, number of languages); ``und`` without a letter."""
        kept = self.proportions(text)
        if not kept:
            return "und", 0.0, 0
        lang = min(kept, key=lambda l: (-kept[l], l))
        return lang, min(1.0, kept[lang]), len(kept)


def _spans(first: np.ndarray, n: int, words: int = 20_000):
    """(first letter, end letter, first word, end word) in pieces of a bounded size."""
    for i in range(0, len(first), words):
        j = min(len(first), i + words)
        yield first[i], (first[j] if j < len(first) else n), i, j


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for lang, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                bins, _ = trigrams(text)
                if lang not in total:
                    total[lang] = np.zeros(BINS, np.int64)
                total[lang] += np.bincount(bins, minlength=BINS)
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(some), pa.string()), "bin": pa.array(some.astype(np.int32)), "n": pa.array(counts[some]),
        })


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModels:
    """Trigram models from ``docs`` (doc_id, text, lang) that are not held out.

    At most BINS numbers per language reach the driver."""
    usable = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").count().orderBy("lang").collect()
    # about sample_docs of each language, picked by hash
    share = F.lit(0.0)
    for lang, n in sizes:
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / n)).otherwise(share)
    picked = usable.where(sampled(F.col("doc_id"), share)).select("lang", "text")
    rows = (
        picked.mapInArrow(_count_trigrams, "lang string, bin int, n long")
        .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    )
    langs = [lang for lang, _ in sizes]
    counts = np.zeros((len(langs), BINS))
    if len(rows):
        counts[np.searchsorted(np.array(langs, object), rows["lang"].to_numpy(object)), rows["bin"]] = rows["n"]
    return LanguageModels(langs, counts)


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """``(doc_id, lang_pred, score, n_langs)`` per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((models.langs, models.counts))

    def make():
        model = LanguageModels(*shared.value)
        return lambda doc_id, text: (doc_id, *model.predict(text))

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, lang_pred string, score double, n_langs int")


def op3_language_mixture(spark, sf_dir):
    """Language of every document.

    Null texts and texts without a letter are ``und`` with score 0, as is all
    when no labelled row is there to learn from; repeated rows are answered each.
    """
    from ticklake.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(docs))
    flag = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", flag.alias("held_out"), "lang_pred", "score", "n_langs")
