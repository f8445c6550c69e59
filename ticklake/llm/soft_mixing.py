"""Mixing to target weights with soft domain membership (operator 1).

DataFrame functions only.

1. Classifier: a table of counts (feature bin x domain) over a bounded sample of
   labelled documents, a naive Bayes model over binned text features. It gives
   every document a posterior over the domains.
2. Rates: document i with n_i tokens and posterior p_i gets a rate r_i >= 0, the
   expected number of its copies. Domain d then has the expected tokens
   A_d = sum_i r_i n_i p_id. Projected-gradient least squares lowers
   (A - t)' H (A - t) / 2 towards the target totals t: in the metric weighted by
   n_i a step is r_i <- max(0, r_i - p_i . H (A - t)). H is the inverse of
   M + diag(s). M is sum_i n_i p_i p_i' over the documents whose rate is above 0
   (the others do not answer to a step down); whenever a step ends farther off
   than it began, M is blended with the sum over all documents, whose steps never
   overshoot. The softening s starts at SOFTEN * t and falls to a quarter every
   round, down to LEAST_SOFT of that: well-stocked domains settle first, those
   with hardly a document after them. A round is one aggregation to D rows of D
   sums. The rounds end when every total is within TOLERANCE of the budget from
   its target, or when s is at its floor and the totals stand still (targets out
   of reach). What is left is returned (``Mixture.gaps``, and the largest one in
   the column target_gap).

What the driver holds is D x D numbers. Rates start at 1, so documents
are moved no further than the targets ask. A rate depends on the posterior
alone, so the steps are replayed beside each row, without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import sampled, stored

SAMPLE_ROWS = 20_000
BINS = 16
MAX_ROUNDS = 500  # a guard; target_gap tells if it ever ends the rounds
TOLERANCE = 1e-3
STILL = 1e-6
SOFTEN = 0.1
LEAST_SOFT = 1e-8
LEAST_TARGET = 1e-3
KEEP_EVERY = 10

# Text features: characters of a class per character.
# The classes.
RATES = {
    "capitals": "[A-Z]",
    "signs": "[!*#$%&@+=|~^_]",
    "digits": "[0-9]",
    "stops": "[.,;:?]",
    "umlauts": "[äöüß]",
    "graves": "[éèêçà]",
    "tildes": "[ñóíáú]",
}
FEATURES = (*RATES, "word_length", "distinct_words", "log_tokens")


def tokens_of(words: Column) -> Column:
    """Number of tokens in a text split at white space (blank ends leave an empty
    first or last piece)."""
    blank = lambda w: (w == "").cast("int")
    n = F.size(words)
    return (n - blank(F.element_at(words, 1)) - F.when(n > 1, blank(F.element_at(words, -1))).otherwise(0)).cast("bigint")


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_mix_n`` (tokens) and ``_mix_x`` (array of FEATURES)."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    w, n = F.col("_mix_w"), F.col("_mix_n")
    # one pass leaves the few signs that the classes tell apart; counting what
    # remains of each class makes no string per match
    of_class = lambda p: F.length(F.regexp_replace("_mix_t", "[^" + p[1:] + "+", ""))
    x = [of_class(p) / chars for p in RATES.values()]
    x += [chars / (n + 1), F.size(F.array_distinct(w)) / F.size(w), F.log1p(n.cast("double"))]
    return (
        docs.withColumn("_mix_t", F.regexp_replace(t, r"[a-z\s]+", ""))
        .withColumn("_mix_w", F.split(t, r"\s+")).withColumn("_mix_n", tokens_of(w))
        .withColumn("_mix_x", F.array(*(c.cast("double") for c in x))).drop("_mix_w", "_mix_t")
    )


@dataclass
class DomainTable:
    """Counts of the labelled sample as log probabilities."""

    domains: list[str]
    cuts: list[list[float]]  # per feature, rising
    prior: list[float]
    cells: list[list[list[float]]]  # domain x feature x bin

    def with_posterior(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``_mix_x``) plus ``_mix_p``, the array of P(domain | features)
        in the order of ``domains``. Each step is a column of its own, so that
        none is computed again for every element of the next."""
        x = F.col("_mix_x")
        bins = F.col("_mix_b")
        tables = F.array(*(
            F.struct(F.lit(p).alias("prior"), F.array(*(F.array(*map(F.lit, f)) for f in cell)).alias("cell"))
            for p, cell in zip(self.prior, self.cells)
        ))
        score = F.transform(
            tables,
            lambda t: F.aggregate(
                F.arrays_zip(t["cell"].alias("f"), bins.alias("b")), t["prior"],
                lambda acc, z: acc + F.element_at(z["f"], z["b"]),
            ),
        )
        return (
            df.withColumn("_mix_b", F.array(*(bin_of(x[k], cut) + 1 for k, cut in enumerate(self.cuts))))
            .withColumn("_mix_s", score)
            .withColumn("_mix_top", F.array_max("_mix_s"))
            .withColumn("_mix_e", F.transform("_mix_s", lambda v: F.exp(v - F.col("_mix_top"))))
            .withColumn("_mix_z", F.aggregate("_mix_e", F.lit(0.0), lambda a, b: a + b))
            .withColumn("_mix_p", F.transform("_mix_e", lambda v: v / F.col("_mix_z")))
            .drop("_mix_b", "_mix_s", "_mix_top", "_mix_e", "_mix_z")
        )


def bin_of(value: Column, cuts: list[float]) -> Column:
    """Number of cuts below ``value``."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value)) if cuts else F.lit(0)


def fit_domains(docs: DataFrame, labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DomainTable:
    """From ``docs`` (doc_id, text) and ``labelled`` (doc_id, domain string).

    At most about ``rows`` labelled documents are used, picked by a hash of
    doc_id. A doc_id labelled twice takes its smallest domain, one with several
    texts the smallest features.
    """
    wanted = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    take = min(1.0, rows / max(1, wanted.count()))
    one = wanted.where(sampled(F.col("doc_id"), take))
    # at most about ``rows`` labels, and one row of each id, however often it occurs
    picked = with_features(docs.select("doc_id", "text").join(F.broadcast(one), "doc_id"))
    sample = stored(picked.groupBy("doc_id", "domain").agg(F.min("_mix_x").alias("x")).select("domain", "x"), "domains")
    sizes = sample.groupBy("domain").count().orderBy("domain").collect()
    at = [k / BINS for k in range(1, BINS)]
    found = sample.agg(*(F.percentile_approx(F.col("x")[k], at, 1000).alias(f"c{k}") for k in range(len(FEATURES)))).first()
    cuts = [sorted(set(found[k] or [])) for k in range(len(FEATURES))]
    binned = [F.struct(F.lit(k).alias("f"), bin_of(F.col("x")[k], cut).alias("b")) for k, cut in enumerate(cuts)]
    counts = sample.select("domain", F.explode(F.array(*binned)).alias("z")).groupBy("domain", "z.f", "z.b").count().collect()
    place = {r["domain"]: k for k, r in enumerate(sizes)}
    cells = [[[1.0] * (len(cut) + 1) for cut in cuts] for _ in sizes]
    for r in counts:
        cells[place[r["domain"]]][r["f"]][r["b"]] += r["count"]
    total = sum(r["count"] for r in sizes)
    return DomainTable(
        [r["domain"] for r in sizes], cuts, [math.log(r["count"] / total) for r in sizes],
        [[[math.log(v / sum(f)) for v in f] for f in cell] for cell in cells],
    )


@dataclass
class Mixture:
    table: DomainTable
    targets: list[float]  # tokens per domain
    before: list[float]  # domain tokens at rate 1
    after: list[float] = field(default_factory=list)
    steps: list[list[float]] = field(default_factory=list)  # H (A - t) of each round

    @property
    def gaps(self) -> dict[str, float]:
        """Per domain: tokens above its target, as a share of all targets."""
        budget = sum(self.targets) or 1.0
        return {d: (a - t) / budget for d, a, t in zip(self.table.domains, self.after, self.targets)}

    def rate(self, p: Column, steps: list[list[float]] | None = None, start: Column | None = None) -> Column:
        """Replays the projected steps for a posterior array."""
        steps = self.steps if steps is None else steps
        start = F.lit(1.0) if start is None else start
        if not steps:
            return start
        down = lambda r, g: F.greatest(F.lit(0.0), r - _dot(p, g, len(self.targets)))
        return F.aggregate(F.array(*(F.array(*map(F.lit, g)) for g in steps)), start, down)


def _dot(p: Column, g: Column, n: int) -> Column:
    if n > 50:  # a tree of that depth is slow to plan; same sums, same order
        return F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    out = p[0] * g[0]
    for k in range(1, n):
        out = out + p[k] * g[k]
    return out


def _totals(mass: DataFrame, size: int, rate: Column) -> tuple[np.ndarray, np.ndarray]:
    """Domain tokens at ``rate``, and the sum of n p p' where it is above 0."""
    own = mass.withColumn("now", rate)
    each = own.select(F.posexplode(F.transform("p", lambda v: v * F.col("n"))).alias("i", "x"), "p", "now")
    x, now = F.col("x"), F.col("now")
    rows = each.groupBy("i").agg(F.sum(x * now).alias("a"), *(F.sum(F.when(now > 0, x * F.col("p")[j])).alias(f"m{j}") for j in range(size)))
    totals, gram = np.zeros(size), np.zeros((size, size))
    for i, a, *m in rows.collect():
        totals[i], gram[i] = a or 0.0, [v or 0.0 for v in m]
    return totals, (gram + gram.T) / 2


def solve(mass: DataFrame, table: DomainTable, weights: dict[str, float], budget: float | None = None,
          max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE) -> Mixture:
    """Projected gradient over ``mass`` (n long, p array), one row per document.

    ``weights`` are normalised over the table's domains (a domain without a
    weight gets 0); ``budget`` is the wanted number of tokens, by default all
    there are. Any number of domains; the module's text tells when it ends.
    """
    size = len(table.domains)
    p = F.col("p")
    before, gram = _totals(mass, size, F.lit(1.0))
    budget = float(before.sum()) if budget is None else budget
    given = [max(0.0, weights.get(d, 0.0)) for d in table.domains]
    mix = Mixture(table, [budget * w / (sum(given) or 1.0) for w in given], before.tolist(), before.tolist())
    if not budget:
        return mix
    targets, now, free, blend = np.array(mix.targets), before, gram, 0.0
    soft, share = SOFTEN * np.maximum(targets, LEAST_TARGET * budget), 1.0
    held, kept = mass.withColumn("r", F.lit(1.0)), 0
    for k in range(max_rounds):
        off = now - targets
        if np.abs(off).max() <= tolerance * budget:
            break
        metric = blend * gram + (1 - blend) * free + np.diag(soft * share)
        mix.steps.append(np.linalg.solve(metric, off).tolist())
        rate = mix.rate(p, mix.steps[kept:], F.col("r"))
        if len(mix.steps) - kept == KEEP_EVERY:
            held, kept, rate = stored(held.withColumn("r", rate), "rates"), len(mix.steps), F.col("r")
        last, (now, free) = now, _totals(held, size, rate)
        mix.after = now.tolist()
        farther = np.abs(now - targets).max() > np.abs(off).max()
        blend = min(1.0, 2 * blend + 0.1) if farther else 0.7 * blend
        if share == LEAST_SOFT and np.abs(now - last).max() <= STILL * budget:
            break
        share = max(LEAST_SOFT, share / 4)
    return mix


ADDED = ("n_tokens", "domain", "posterior", "rate", "target_gap")


def mix(docs: DataFrame, table: DomainTable, weights: dict[str, float], budget: float | None = None,
        carry: list[str] | None = None) -> tuple[DataFrame, Mixture]:
    """Rows of ``docs`` (columns ``carry``, by default all) plus n_tokens, domain
    (likeliest), posterior (map), rate and target_gap (the largest distance of a
    domain from its target that is left, as a share of the budget, in every row);
    and the solution.

    Null and empty texts have no tokens and the posterior of an empty text;
    repeated rows get the same rate; with no labelled document every rate is 1
    and the domain and target_gap null; an empty table gives no rows. Columns that are named
    like the added ones are replaced.
    """
    names = [c for c in carry or docs.columns if c not in ADDED]
    # the row travels as one struct, so that no column of it can clash
    rows = docs.select(F.struct(*([F.col(f"`{c}`") for c in names] or [F.lit(0)])).alias("row"), "text")
    own, added = [F.col("row")[c].alias(c) for c in names], list(ADDED)
    if not table.domains:
        return with_features(rows).select(
            "row", F.col("_mix_n").alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
            F.lit(None).cast("map<string,double>").alias("posterior"), F.lit(1.0).alias("rate"),
            F.lit(None).cast("double").alias("target_gap"),
        ).select(*own, *added), Mixture(table, [], [])
    found = table.with_posterior(with_features(rows)).select("row", "_mix_n", "_mix_p")
    held = stored(found, "posteriors")  # texts are read once
    p = F.col("_mix_p")
    solved = solve(held.select(F.col("_mix_n").alias("n"), p.alias("p")), table, weights, budget)
    domains = F.array(*map(F.lit, table.domains))
    return held.select(
        "row", F.col("_mix_n").alias("n_tokens"),
        F.element_at(domains, F.array_position(p, F.array_max(p)).cast("int")).alias("domain"),
        F.map_from_arrays(domains, p).alias("posterior"), solved.rate(p).alias("rate"),
        F.lit(max(map(abs, solved.gaps.values()))).alias("target_gap"),
    ).select(*own, *added), solved


# The query's domains are language/quality of the labelled documents, its
# target: nine tenths good text, English a little under half.
WEIGHTS = {
    "en/1": 0.42, "de/1": 0.16, "fr/1": 0.16, "es/1": 0.16,
    "en/0": 0.04, "de/0": 0.02, "fr/0": 0.02, "es/0": 0.02,
}


def quality_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: ``lang/quality``."""
    quality = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    lang = docs.where("doc_id is not null and lang is not null").select("doc_id", "lang")
    return lang.join(quality, "doc_id").select("doc_id", F.concat_ws("/", "lang", F.col("quality").cast("string")).alias("domain"))


def mix_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS,
                  carry: list[str] | None = None) -> DataFrame:
    """``docs`` with rates that bring the domains to ``weights`` (see ``mix``)."""
    table = fit_domains(docs, stored(quality_domains(docs, labels), "domains"))
    return mix(docs, table, weights, carry=carry)[0]


def op1_soft_mixing(spark, sf_dir):
    """Posterior and rate of every document."""
    from ticklake.llm.common import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mix_documents(docs.select("doc_id", "text", "lang"), labels, carry=["doc_id"])
