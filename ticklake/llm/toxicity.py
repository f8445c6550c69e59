"""Toxicity by gradient-boosted trees over dense features (operator 7).

Per document one dense vector: lexicon densities, second-person proximity,
capitals, punctuation and obfuscation rates (``FEATURES``). The lexicon is a
fixed seed list plus words and word beginnings learned from labelled rows.
Spark ML's gradient-boosted trees give a raw probability, isotonic regression
(Spark ML) calibrates it.

Fitting uses a bounded sample of labelled rows, at most about ``SAMPLE_ROWS``,
taken by a hash of doc_id; rows whose crc32(doc_id) mod 5 is 0 are never
fitted on. The other remainders are split, so that no step grades itself:
3 and 4 learn the lexicon, 2 the trees, 1 the calibration. Scoring reads the
text alone and is a plain map over every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import held_out, sampled, stored

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 4_000  # learned entries, the strongest first
LEAST_DOCS = 4
PREFIXES = (4, 5)
NEAR = 3  # words between a hit and a second-person word

# Insults that count everywhere, and second-person words.
SEED = frozenset("""
    idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting clown clowns
    garbage filth vermin pig pigs fool fools jerk creep freak bastard bitch whore slut crap shit fuck asshole
    hate kill die ugly useless retard imbecile
""".split())
SECOND = frozenset("""
    you your yours yourself u ur ya du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos
    tú ti tuyo usted ustedes vosotros
""".split())

FEATURES = (
    "seed_density", "learned_density", "learned_strength", "strongest", "distinct_hits", "hit_share_log",
    "second_person_near", "capitals", "shouted_words", "punctuation", "punctuation_runs", "obfuscated", "log_words",
)

_TOKEN = re.compile(r"[^\W_]+(?:[@$!*'’-]+[^\W_]+)*")
_RUN = re.compile(r"[!?*#@$%&]{2,}")
_MIXED = re.compile(r"[^\W\d_][\d@$!*]+[^\W\d_]")
# Signs that stand in for letters.
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "-": "", "'": "", "’": ""})


def units_of(word: str) -> list[str]:
    """A word and its beginnings (marked with a trailing ``~``)."""
    return [word, *(word[:n] + "~" for n in PREFIXES if len(word) > n)]


class Features:
    """Text -> dense vector, with a learned lexicon (unit -> log odds)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[float, bool]] = {}

    def weigh(self, word: str) -> tuple[float, bool]:
        """(strongest log odds of the word's units or 0, is a seed word)."""
        if word in self.known:
            return self.known[word]
        low = word.lower()
        plain = low if low.isalpha() else low.translate(_PLAIN)
        get = self.lexicon.get
        w = max(get(u, 0.0) for x in {low, plain} for u in units_of(x))
        if len(self.known) >= 200_000:
            self.known.clear()
        self.known[word] = out = (w, low in SEED or plain in SEED)
        return out

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words = _TOKEN.findall(text)
        n, chars = max(len(words), 1), max(len(text), 1)
        weigh = self.weigh
        hits = [(k, w, s) for k, (w, s) in enumerate(map(weigh, words)) if w > 0 or s]
        near = 0
        for k, _, _ in hits:
            near += any(x.lower() in SECOND for x in words[max(0, k - NEAR) : k + NEAR + 1])
        learned = [w for _, w, _ in hits if w > 0]
        upper = sum(map(str.isupper, text))
        return [
            sum(s for _, _, s in hits) / n,
            len(learned) / n,
            sum(learned) / n,
            max(learned, default=0.0),
            float(len({words[k].lower() for k, _, _ in hits})),
            math.log1p(len(hits)),
            near / n,
            upper / chars,
            sum(len(x) > 1 and x.isupper() for x in words) / n,
            sum(text.count(c) for c in "!?.,;:") / chars,
            len(_RUN.findall(text)) / n,
            len(_MIXED.findall(text)) / n,
            math.log1p(len(words)),
        ]


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, documents, toxic documents), summed per batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            docs, bad = Counter(), Counter()
            for text, toxic in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                seen = {u for w in set(_TOKEN.findall((text or "").lower())) for u in units_of(w)}
                docs.update(seen)
                if toxic:
                    bad.update(seen)
            yield pa.RecordBatch.from_pydict({
                "unit": list(docs),
                "n": pa.array(docs.values(), pa.int64()),
                "t": pa.array([bad[u] for u in docs], pa.int64()),
            })


def learn_lexicon(sample: DataFrame, size: int = LEXICON_ROWS) -> dict[str, float]:
    """Units whose documents are far likelier toxic than all are (``sample``:
    text, toxic). At most ``size`` entries reach the driver."""
    total = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    clean, bad = total[0] - total[1], total[1]
    if not clean or not bad:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(_unit_counts, "unit string, n long, t long").groupBy("unit").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    odds = F.log((F.col("t") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    rows = (
        counts.where(F.col("n") >= LEAST_DOCS).withColumn("w", odds).where("w >= 2 and t >= 0.5 * n")
        .orderBy(F.desc("w"), "unit").limit(size).select("unit", "w").collect()
    )
    return dict(rows)


@dataclass
class ToxicityModel:
    lexicon: Broadcast
    trees: object | None  # None: one class only, ``base`` is every score
    scale: object | None
    base: float

    def features(self, text: Column) -> Column:
        lexicon = self.lexicon

        @F.arrow_udf("array<double>")
        def dense(texts: pa.Array) -> pa.Array:
            make = Features(lexicon.value)
            out = []
            for at in range(0, len(texts), 500):
                out += [make(t) for t in texts.slice(at, 500).to_pylist()]
            return pa.array(out, pa.list_(pa.float64()))

        return dense(text)

    def score(self, docs: DataFrame, text: str = "text", to: str = "score") -> DataFrame:
        """``docs`` with a column ``to``; the model's own columns start with ``_tox``."""
        if self.trees is None:
            return docs.withColumn(to, F.lit(self.base))
        raw = self.trees.transform(docs.withColumn("_tox_x", array_to_vector(self.features(F.col(text)))))
        raw = raw.withColumn("_tox_p1", vector_to_array("_tox_p")[1])
        if self.scale is not None:
            raw = self.scale.transform(raw)
        p = F.col("_tox_s" if self.scale is not None else "_tox_p1")
        safe = F.when(F.isnan(p), F.lit(self.base)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
        return raw.withColumn(to, safe).drop("_tox_x", "_tox_r", "_tox_p", "_tox_y", "_tox_p1", "_tox_s")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(part, text, toxic)`` of at most about ``rows`` labelled documents that
    are not held out. A doc_id labelled twice is toxic if any label says so."""
    wanted = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    share = min(1.0, rows / max(1, wanted.count()))
    one = (
        wanted.where(sampled(F.col("doc_id"), share))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    # at most about SAMPLE_ROWS ids of 12 bytes
    picked = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    return stored(picked.select(part.alias("part"), "text", "toxic"), "labelled")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, rows)
    lexicon = learn_lexicon(sample.where("part in (3, 4)"))
    base = sample.agg(F.avg("toxic")).first()[0] or 0.0
    model = ToxicityModel(spark.sparkContext.broadcast(lexicon), None, None, float(base))
    dense = stored(
        sample.where("part in (1, 2)")
        .select("part", F.col("toxic").cast("double").alias("_tox_y0"), model.features(F.col("text")).alias("x")),
        "features",
    ).withColumn("_tox_x", array_to_vector("x"))
    for_trees = dense.where("part = 2")
    if for_trees.select("_tox_y0").distinct().count() < 2:
        return model
    trees = GBTClassifier(
        featuresCol="_tox_x", labelCol="_tox_y0", predictionCol="_tox_y", maxIter=15, maxDepth=3, stepSize=0.3, seed=7
    ).setRawPredictionCol("_tox_r").setProbabilityCol("_tox_p")
    model.trees = trees.fit(for_trees.coalesce(2))
    graded = model.trees.transform(dense.where("part = 1")).withColumn("_tox_p1", vector_to_array("_tox_p")[1])
    if graded.take(1):
        model.scale = IsotonicRegression(featuresCol="_tox_p1", labelCol="_tox_y0", predictionCol="_tox_s").fit(graded)
    return model


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``.

    Null and empty texts are scored like any text (no words); repeated rows are
    scored each; a null doc_id has a null held_out of false; without labels of
    both classes every score is the share of toxic rows (0 without labels).
    """
    own = docs.select("doc_id", "text")
    scored = fit(own, labels).score(own)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic."""
    # the row travels as one struct, so that no column of it can clash
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    scored = fit(docs, labels).score(rows)
    return scored.where("score < 0.5").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def op7_toxicity(spark, sf_dir):
    """Every document, scored."""
    from ticklake.llm.common import table

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
