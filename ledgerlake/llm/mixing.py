"""Mixing to target weights with soft domain membership, with DataFrame functions only.

``train`` fits a naive Bayes classifier on a bounded sample of the labelled rows: hashed word
counts for each domain. ``posteriors`` gives each document the probabilities of the domains and
its number of words. ``solve`` finds nonnegative document rates r by projected gradient on

    sum over domains k of (sum over documents d of r_d * n_d * p_dk - T_k)^2,

n being words, p posteriors and T target totals. A step is one aggregate over the documents, of
which a few numbers for each pair of domains reach the driver; a rate is
a function of the document's posteriors and of the steps so far, so nothing is rewritten between
steps. The gradient is scaled by the inverse of the domains' Gram matrix, so that it leads straight
to the solution as long as no further rate becomes zero; of all solutions this is the one nearest
to rate 1. Targets that no rates can reach are approached, within ``steps`` aggregates.

A domain with target 0 is unwanted: documents that are more likely of it than of any other get rate 0,
and the rates of the others are scaled by their probability to be wanted before the other domains'
targets are solved for. What such documents hold of it in expectation stays. (As an equation, target 0
would be met only by dropping clean documents too, as no posterior is quite zero.)

Words are lower-cased runs between spaces, line breaks, tabs and ``.,;:!?``. Null and empty texts
have no words, the prior as posteriors, and a rate like any other. Without labelled rows all
posteriors are equal. A document that occurs twice counts twice. Columns of ``docs`` are passed
through; columns named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import stored

BUCKETS = 1 << 14
TARGETS = {"good": 0.72, "low": 0.28, "toxic": 0.0}


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled documents that are learned from, by rate (not exactly)."""

    sample: int = 10000
    smoothing: float = 0.5
    least_weight: float = 0.3  # smaller weights of a word are noise and left out
    steps: int = 40
    tolerance: float = 1e-4


def words_of(text: Column) -> Column:
    spaced = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\t\r.,;:!?", "         ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def buckets_of(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.pmod(F.hash(w), F.lit(BUCKETS)))


def _numbers(values: list[float]) -> Column:
    """A constant array; as one literal it stays small in the plan."""
    return F.split(F.lit(",".join(f"{v:.4g}" for v in values)), ",").cast("array<float>")


def _sum_of_weights(weights: list[float]) -> Column:
    array = _numbers(weights)
    return F.aggregate("_buckets", F.lit(0.0), lambda total, bucket: total + F.get(array, bucket))


@dataclass(frozen=True)
class Model:
    """``weights`` has one array of BUCKETS numbers for each domain: bounded, whatever the input."""

    domains: list[str]
    priors: list[float]
    weights: list[list[float]]


def train(docs: DataFrame, labels: DataFrame, domains: list[str], settings: Settings = Settings()) -> Model:
    """``labels`` has doc_id and domain."""
    per_domain = {r["domain"]: r["count"] for r in labels.groupBy("domain").count().collect()}
    n = sum(per_domain.get(d, 0) for d in domains)
    share = min(1.0, settings.sample / max(n, 1))
    sampled = labels.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    sample = stored(sampled.select(F.col("doc_id").alias("_labelled"), "domain"), "labelled-sample")
    rows = docs.join(sample, F.col("doc_id") == F.col("_labelled")).select("domain", F.explode(buckets_of(F.col("text"))).alias("bucket"))
    counts = [[0] * BUCKETS for _ in domains]
    for r in rows.groupBy("domain", "bucket").count().collect():
        counts[domains.index(r["domain"])][r["bucket"]] = r["count"]
    totals, s = [sum(c) + settings.smoothing * BUCKETS for c in counts], settings.smoothing
    everywhere, every = [sum(c) for c in zip(*counts)], sum(totals)
    weights = []
    for c, total in zip(counts, totals):
        raw = [math.log((x + s) / total) - math.log((y + s * len(domains)) / every) for x, y in zip(c, everywhere)]
        weights.append([w if abs(w) >= settings.least_weight and y >= 5 else 0.0 for w, y in zip(raw, everywhere)])
    priors = [(per_domain.get(d, 0) + 1) / (n + len(domains)) for d in domains]
    return Model(domains, priors, weights)


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with n_words and p_<domain>."""
    scored = docs.withColumn("_buckets", buckets_of(F.col("text")))
    score = [_sum_of_weights(w) + F.lit(math.log(prior)) for prior, w in zip(model.priors, model.weights)]
    columns = [f"_s{k}" for k in range(len(score))]
    scored = scored.withColumn("n_words", F.size("_buckets").cast("long")).withColumns(dict(zip(columns, score))).drop("_buckets")
    top = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])
    scored = scored.withColumn("_top", top)
    odds = [F.exp(F.col(c) - F.col("_top")) for c in columns]
    total = sum(odds[1:], odds[0])
    found = F.struct("n_words", *[(o / total).alias(f"p_{d}") for d, o in zip(model.domains, odds)])
    # A generator of one row: a filter on what it makes stays above it. Pushed below, it would hold the
    # whole scoring once for each mention of a posterior.
    return scored.select(*[c for c in docs.columns], F.inline(F.array(found)))


def _rate(domains: list[str], history: list[list[float]]) -> Column:
    """The rate after the steps so far: start at 1, take each step, stay nonnegative.

    Plain arithmetic on the posterior columns: inside a lambda the optimizer would put their whole
    computation in place of each reference.
    """
    rate = F.lit(1.0)
    for step in history:
        moves = [F.lit(size) * F.col(f"p_{d}") for d, size in zip(domains, step)]
        rate = F.greatest(F.lit(0.0), rate - sum(moves[1:], moves[0]))
    return rate


def solve(weighted: DataFrame, targets: Mapping[str, float], settings: Settings = Settings()) -> list[list[float]]:
    """The steps; ``weighted`` has n_words and p_<domain>, ``targets`` are total words for each domain.

    One aggregate for each step gives the totals, the Gram matrix of the domains over documents
    whose rate is positive, and its trace over all documents. A scaled step that does not bring
    the totals nearer to the targets is halved, and in the end replaced by a plain gradient step,
    which always does unless the solution is reached.
    """
    domains = list(targets)
    pairs = [(i, j) for i in range(len(domains)) for j in range(i + 1)]
    goal, p = np.array(list(targets.values()), dtype=float), [F.col(f"p_{d}") for d in domains]
    history: list[list[float]] = []
    best, last, tries = math.inf, np.zeros(len(domains)), 0
    for _ in range(settings.steps):
        rows = weighted.withColumn("_rate", _rate(domains, history))
        words, active = F.col("n_words"), F.when(F.col("_rate") > 0, F.col("n_words"))
        sums = [F.sum(F.col("_rate") * words * x) for x in p] + [F.sum(active * p[i] * p[j]) for i, j in pairs] + [F.sum(words * x * x) for x in p]
        found = [float(x or 0.0) for x in rows.agg(*[x.alias(f"s{k}") for k, x in enumerate(sums)]).first()]
        residual, trace = np.array(found[: len(domains)]) - goal, sum(found[-len(domains) :])
        if np.abs(residual).max() <= settings.tolerance * max(goal.sum(), 1e-9):
            return history
        if (error := float(residual @ residual)) < best * (1 - 1e-6):
            gram = np.zeros((len(domains),) * 2)
            for (i, j), value in zip(pairs, found[len(domains) :]):
                gram[i, j] = gram[j, i] = value
            ridge = np.eye(len(domains)) * (1e-9 * trace + 1e-12)
            best, last, tries = error, residual, 0
            history.append(np.linalg.solve(gram + ridge, residual).tolist())
        elif tries < 3:
            tries += 1
            history[-1] = [x / 2 for x in history[-1]]
        elif tries == 3:
            tries += 1
            history[-1] = (last / max(trace, 1e-9)).tolist()
        else:
            break
    return history[:-1]  # the last step has not been looked at, or did no good


def _wanted(shares: Mapping[str, float]) -> tuple[list[str], Column, Column]:
    """The wanted domains, a document's probability to be of them, and whether an unwanted one is the likeliest."""
    wanted, unwanted = [d for d in shares if shares[d] > 0], [F.col(f"p_{d}") for d in shares if shares[d] <= 0]
    if not unwanted or not wanted:
        return wanted, F.lit(1.0), F.lit(not wanted)
    likeliest = [F.greatest(*x) if len(x) > 1 else x[0] for x in (unwanted, [F.col(f"p_{d}") for d in wanted])]
    return wanted, F.greatest(F.lit(0.0), F.lit(1.0) - sum(unwanted[1:], unwanted[0])), likeliest[0] > likeliest[1]


def _final_rate(shares: Mapping[str, float], history: list[list[float]]) -> Column:
    wanted, chance, dropped = _wanted(shares)
    return F.when(dropped, F.lit(0.0)).otherwise(_rate(wanted, history) * chance)


def _fitted(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float], settings: Settings) -> tuple[DataFrame, list[list[float]], Model]:
    """The weighted documents without their text, the steps, and the classifier."""
    domains = list(shares)
    made = {"n_words", "rate", *(f"p_{d}" for d in domains)}
    model = train(docs, labels, domains, settings)
    scored = posteriors(docs.select(*[c for c in docs.columns if c not in made]), model).drop("text")
    weighted = stored(scored, "posteriors")
    total = weighted.agg(F.sum("n_words")).first()[0] or 0
    wanted, chance, dropped = _wanted(shares)
    history = solve(weighted.where(~dropped).withColumn("n_words", F.col("n_words") * chance), {d: shares[d] * total for d in wanted}, settings) if wanted else []
    return weighted, history, model


def rates(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float] = TARGETS, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the text, with n_words, p_<domain> and rate.

    Expected words for each domain with a positive share, at these rates, meet its share of all words.
    """
    weighted, history, _ = _fitted(docs, labels, shares, settings)
    return weighted.withColumn("rate", _final_rate(shares, history))


def with_rates(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float] = TARGETS, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with n_words, p_<domain> and rate; texts are scored once more instead of shuffled."""
    _, history, model = _fitted(docs.select("doc_id", "text"), labels, shares, settings)
    made = {"n_words", "rate", *(f"p_{d}" for d in shares)}
    return posteriors(docs.select(*[c for c in docs.columns if c not in made]), model).withColumn("rate", _final_rate(shares, history))


def domain_labels(labels: DataFrame) -> DataFrame:
    """The given label table as doc_id and domain; rows without a label of quality are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull()).distinct()
