"""Mixes documents to target weights of domains that are known only softly.

Three steps, all in DataFrame functions:

1. A classifier learns domains from a labelled table: normal distributions of
   about twenty rates of characters and character pairs per domain (Gaussian
   naive Bayes). Every document gets posteriors; likelihoods are raised to
   ``1 / SOFTNESS``, as the rates of one text are not independent.
2. Nonnegative document rates are fitted by projected-gradient least squares, so
   that the expected tokens of each domain, the sum of rate x tokens x posterior,
   meet the targets. A step takes one aggregation of as many sums as domains;
   the rates follow from the steps so far, so no state is kept per document. The
   residual is measured in the metric of the domains' overlaps, in which a step of
   length one is right; without a rate at zero the first step is exact.
3. A document is taken ``floor(rate)`` times and once more by a coin with the rest
   as its chance. The coin is a hash of id and text, so it can be repeated.

Only sums per domain reach the driver. Labelled rows are all used. Where the targets are
out of reach of nonnegative rates, or the steps run out, the best step counts, ``Mix.miss``
says how far off it is, and a warning is given.

Defined cases: a null or empty text has no tokens and all rates zero; it is mixed by
the posteriors of that. Labelled rows without a domain or document are skipped. Targets
of domains that no labelled row has are shared among the others. A labelled domain
without a weight has its present share as target and is not thinned to get there; a
weight of 0 takes a domain out. Without any domain every rate is 1. Repeated rows are
mixed row by row. The counted characters suit English, German, French and Spanish;
domains of other languages are told apart less well. A very long text counts whole. An
empty table gives no rows. ``rates`` reads only id and text; ``mixed`` keeps columns of any name.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written

SOFTNESS = 4.0
#: Steps at most, and the share of all tokens by which a domain may miss its target.
STEPS, TOLERANCE = 25, 1e-4
SEED = 31

#: Characters and pairs whose rates tell languages and kinds of text apart.
_COUNTED = ("th", "en", "qu", "ou", "ch", "ci", "a", "o", "z", "w", "é", "ó", "ü", "ñ", "!", "|", "%", ".", "\n")

def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), 0)


def token_count(text: str) -> Column:
    """White-space words of a text."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+")).cast("long")


def features(text: str) -> Column:
    """Square roots of the rates per character, as an array."""

    def of(value: Column) -> Column:
        size = F.octet_length(value)
        counts = [(size - F.octet_length(F.replace(value, F.lit(c), F.lit("")))) / len(c.encode()) for c in _COUNTED]
        counts += [size - F.length(value), F.regexp_count(value, F.lit("[A-Z]"))]
        return F.array(*(F.sqrt(x / F.greatest(F.length(value), F.lit(1))).cast("double") for x in counts))

    return _let(F.coalesce(F.col(text), F.lit("")), of)


N_FEATURES = len(_COUNTED) + 2


@dataclass
class Classifier:
    """Per domain: prior, and mean and variance of each rate."""

    domains: list[str]
    prior: list[float]
    mean: list[list[float]]
    variance: list[list[float]]

    def posteriors(self, found: Column) -> Column:
        """Array of the domains' posteriors from an array of features."""

        def odds(f: Column) -> Column:
            out = []
            for prior, mean, variance in zip(self.prior, self.mean, self.variance, strict=True):
                parts = [(f[k] - m) * (f[k] - m) * (-0.5 / v / SOFTNESS) for k, (m, v) in enumerate(zip(mean, variance, strict=True))]
                out.append(_total(parts) + (-0.5 * sum(map(math.log, variance)) / SOFTNESS + math.log(prior)))
            return F.array(*out)

        k = range(len(self.domains))
        likely = lambda x: F.array(*(F.exp(x[d] - F.array_max(x)) for d in k))
        shares = lambda x: F.array(*(x[d] / _total([x[e] for e in k]) for d in k))
        return _let(_let(_let(found, odds), likely), shares)


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def classifier(table: DataFrame, labelled: DataFrame, doc: str) -> Classifier:
    """From all labelled rows (``doc``, ``domain``): one aggregate row per domain."""
    # each id and domain once, or an id that repeats on both sides would count with its square
    rows = table.join(labelled.select(doc, "domain").where("domain is not null").distinct(), doc)
    f = F.col("features")
    wanted = [x for k in range(N_FEATURES) for x in (F.avg(f[k]).alias(f"m{k}"), F.var_pop(f[k]).alias(f"v{k}"))]
    found = sorted(rows.groupBy("domain").agg(F.count("*").alias("n"), *wanted).collect(), key=lambda r: r["domain"])
    total = sum(r["n"] for r in found)
    floor = [max(1e-6, 0.05 * float(np.mean([r[f"v{k}"] for r in found]))) if found else 1e-6 for k in range(N_FEATURES)]
    return Classifier(
        [r["domain"] for r in found],
        [r["n"] / total for r in found],
        [[r[f"m{k}"] for k in range(N_FEATURES)] for r in found],
        [[r[f"v{k}"] + floor[k] for k in range(N_FEATURES)] for r in found],
    )


@dataclass
class Mix:
    """What gives each document its rate: classifier and the steps of the fit."""

    model: Classifier
    steps: list[list[float]]
    #: Tokens of each domain with the fitted rates, and the targets.
    reached: list[float]
    targets: list[float]
    #: The largest difference of the two, as a share of all tokens.
    miss: float = 0.0

    def rate(self, p: Column) -> Column:
        """Nonnegative rate from an array of posteriors: each step moves and projects."""
        out = F.lit(1.0)
        for step in self.steps:
            out = F.greatest(F.lit(0.0), out - _total([p[d] * v for d, v in enumerate(step)]))
        return out


def fit(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, whole: tuple[str, ...] = (), doc: str = "doc_id", text: str = "text") -> tuple[Mix, DataFrame]:
    """The mix, and the table of all documents with id, tokens, coin and posteriors (features without a domain).

    The targets are shares of all tokens there are; with ``whole``, of as many
    more as these domains need so that none of them has to be thinned.
    """
    table = written(docs.select(doc, token_count(text).alias("tokens"), features(text).alias("features"), coin_of(doc, text).alias("coin")), "measured")
    model = classifier(table, labelled, doc)
    if not model.domains:
        return Mix(model, [], [], []), table
    k = len(model.domains)
    table = written(table.withColumn("p", model.posteriors(F.col("features"))).drop("features"), "posteriors")
    p, tokens = F.col("p"), F.col("tokens").cast("double")
    first = table.agg(F.sum(tokens).alias("n"), *(F.sum(tokens * p[a] * p[b]).alias(f"o{a}_{b}") for a in range(k) for b in range(a, k)), *(F.sum(tokens * p[d]).alias(f"s{d}") for d in range(k))).first()
    total = first["n"] or 0.0
    if not total:
        return Mix(model, [], [0.0] * k, [0.0] * k), table
    overlap = np.array([[first[f"o{min(a, b)}_{max(a, b)}"] for b in range(k)] for a in range(k)]) / total
    inverse = np.linalg.pinv(overlap, rcond=1e-6, hermitian=True)
    have = {x: first[f"s{d}"] / total for d, x in enumerate(model.domains)}
    given = np.array([x in weights for x in model.domains])
    wanted = np.array([max(0.0, weights.get(x, 0.0)) for x in model.domains])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(k, given.all() / k)
    kept = np.where(given, 0.0, [have[x] for x in model.domains])
    wanted = kept + wanted * (1 - kept.sum())
    wanted = wanted * max([have[x] / w for x, w in zip(model.domains, wanted, strict=True) if (x in whole or x not in weights) and w], default=1.0)
    mix, best = Mix(model, [], [], (wanted * total).tolist()), None
    for _ in range(STEPS + 1):
        weighed = table.select("p", (tokens * mix.rate(p)).alias("weight"))
        sums = weighed.agg(*(F.sum(F.col("weight") * p[d]).alias(f"s{d}") for d in range(k))).first()
        reached = np.array([sums[f"s{d}"] for d in range(k)]) / total
        miss = float(np.abs(reached - wanted).max())
        if best is None or miss < best[0]:
            best = miss, [*mix.steps], (reached * total).tolist()
        if miss <= TOLERANCE:
            break
        mix.steps.append((inverse @ (reached - wanted)).tolist())
    mix.miss, mix.steps, mix.reached = best
    if mix.miss > TOLERANCE:
        warnings.warn(f"rates miss the target of a domain by {mix.miss:.2%} of all tokens", stacklevel=2)
    return mix, table


def _copies(rate: Column, coin: Column) -> Column:
    return F.floor(rate + coin).cast("int")


def coin_of(*columns: str) -> Column:
    """A number in [0, 1) that the columns decide."""
    return F.pmod(F.xxhash64(F.lit(SEED), *columns), F.lit(1 << 30)) / float(1 << 30)


def rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, whole: tuple[str, ...] = (), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, likeliest domain, its posterior, rate and copies."""
    mix, table = fit(docs, labelled, weights, whole=whole, doc=doc, text=text)
    p = F.col("p")
    if mix.model.domains:
        pairs = [F.struct(p[d].alias("p"), F.lit(x).alias("x")) for d, x in enumerate(mix.model.domains)]
        best = F.array_max(F.array(*pairs))
    else:
        best = F.struct(F.lit(None).cast("double").alias("p"), F.lit(None).cast("string").alias("x"))
    rows = table.select(F.col(doc).alias("doc_id"), F.col("tokens").alias("n_tokens"), best.alias("best"), mix.rate(p).alias("rate"), "coin")
    return rows.select("doc_id", "n_tokens", F.col("best.x").alias("domain"), F.col("best.p").alias("posterior"), "rate", _copies(F.col("rate"), F.col("coin")).alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, whole: tuple[str, ...] = (), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents themselves, each as often as its rate says. No join: a rate follows from the text."""
    mix, _ = fit(docs, labelled, weights, whole=whole, doc=doc, text=text)
    if not mix.model.domains:
        return docs
    rate = _let(mix.model.posteriors(features(text)), mix.rate)
    nth = F.explode(F.array_repeat(F.lit(1), _copies(rate, coin_of(doc, text))))
    names, free = [F.col(f"`{c}`") for c in docs.columns], "nth" + "_" * max(map(len, docs.columns))
    return docs.select(*names, nth.alias(free)).select(*names)


def labelled_by_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and domain ``<lang>/<quality>`` of the labelled documents."""
    rows = docs.select("doc_id", "lang").join(labels.select("doc_id", "quality").distinct(), "doc_id").where("lang is not null and quality is not null")
    return rows.select("doc_id", F.concat_ws("/", "lang", F.col("quality").cast("string")).alias("domain")).distinct()


#: Token shares by language and quality label that the registered query and the pipeline aim at.
WEIGHTS = {"en/1": 0.45, "de/1": 0.17, "fr/1": 0.17, "es/1": 0.11, "en/0": 0.06, "de/0": 0.015, "fr/0": 0.015, "es/0": 0.01}
#: Domains that are not thinned to get there.
WHOLE = ("en/1", "de/1", "fr/1", "es/1")
