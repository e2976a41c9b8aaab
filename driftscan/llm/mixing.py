"""Mixing of sources to target weights with soft domain memberships.

A classifier fitted on the labelled table gives every document a posterior over
domains. Nonnegative document rates are then fitted by projected-gradient least
squares, so that the expected tokens of each domain match its target. With the
gradient scaled by documents' tokens and each domain's error by its total, the
step size is one; steps are accelerated by momentum. An iteration is one
aggregation to a few numbers a domain, and a document's rate is a function of
its posterior and of those numbers. Documents with one posterior thus have one
rate, and iterations read each distinct posterior once, with their tokens.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan.llm import evidence
from driftscan.session import materialize

DOMAINS = ("good", "good_toxic", "low", "low_toxic")


def fit_domains(documents: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> dict[str, evidence.NaiveBayes]:
    """The models behind the posteriors, from at most about max_labelled labelled documents."""
    return evidence.fit(materialize(evidence.labelled_sample(documents, labels, max_labelled), "sample"), ("quality", "toxic"))


def domain_posteriors(documents: DataFrame, models: dict[str, evidence.NaiveBayes], keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns in keep, by default all), tokens (words) and p: posteriors of DOMAINS, in that order."""
    marked = evidence.words_and_style(documents.select(F.struct(*(keep or documents.columns)).alias("row"), "text"))
    odds = marked.select("row", F.col("n_words").alias("tokens"), *(evidence.sigmoid(evidence.log_odds(m)).alias(t) for t, m in models.items()))
    q, t = F.col("quality"), F.col("toxic")
    return odds.select("row", "tokens", F.array(q * (1 - t), q * t, (1 - q) * (1 - t), (1 - q) * t).alias("p"))


def token_sums(posteriors: DataFrame) -> DataFrame:
    """p, each distinct one once, and tokens, the sum over its documents."""
    return posteriors.groupBy("p").agg(F.sum("tokens").alias("tokens"))


def _stepped(state: Column, steps: list[tuple[float, list[float]]], most: float | None) -> Column:
    """state (a struct of rate, ahead and moved) after further steps: each goes from ahead along its errors, projects, and looks ahead by its momentum."""
    if not steps:
        return state
    n = len(steps[0][1])
    table = F.expr("array(" + ", ".join(f"named_struct('m', {m!r}D, " + ", ".join(f"'e{k}', {x!r}D" for k, x in enumerate(e)) + ")" for m, e in steps) + ")")

    def step(s: Column, x: Column) -> Column:
        moved = s["ahead"] - functools.reduce(operator.add, (F.col("p")[k] * x[f"e{k}"] for k in range(n)))
        moved = F.greatest(F.lit(0.0), moved) if most is None else F.greatest(F.lit(0.0), F.least(F.lit(float(most)), moved))
        # a lambda of its own: the projected rate stands in it twice
        return F.transform(F.array(moved), lambda r: F.struct(r.alias("rate"), (r + x["m"] * (r - s["rate"])).alias("ahead"), F.abs(r - s["rate"]).alias("moved")))[0]

    return F.aggregate(table, state, step)


def _first() -> Column:
    return F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"), F.lit(0.0).alias("moved"))


def rate_after(steps: list[tuple[float, list[float]]], most: float | None = None) -> Column:
    """The rate of a document with posterior p after the given steps (momentum, relative errors of the domains)."""
    return _stepped(_first(), steps, most)["rate"]


def fit_rates(posteriors: DataFrame, targets: list[float], most: float | None = None, most_steps: int = 60, tolerance: float = 1e-3, block: int = 8) -> tuple[list[tuple[float, list[float]]], dict]:
    """The accelerated gradient steps for rate_after(), and a report.

    posteriors has tokens and p; targets are expected tokens by domain, in the
    order of p; most bounds the rates from above. The fit ends when every domain
    is within tolerance of its target, relative to the larger of target and
    initial total, or when a step moves no document's rate by the tolerance,
    which is where the rates that least squares allow have been reached. The
    report names totals, targets, what is reached, the number of steps, and
    whether the fit had settled before most_steps. Rates so far are written every
    `block` steps, so that a step's cost does not grow with their number.
    """
    n = len(targets)
    now, at = posteriors.select("tokens", "p", _first().alias("state")), 0

    def totals(steps: list) -> tuple[list[float], list[float], float]:
        rated = now.select("tokens", "p", "state", _stepped(F.col("state"), steps, most).alias("next"))
        sums = [F.sum(F.col("tokens") * F.col(f"next.{c}") * F.col("p")[k]).alias(f"{c}{k}") for c in ("rate", "ahead") for k in range(n)]
        r = [float(x or 0.0) for x in rated.agg(*sums, F.max("next.moved").alias("moved")).first()]
        return r[:n], r[n : 2 * n], r[-1]

    reached, ahead, _ = totals([])
    start = reached
    scale = [max(1.0, a) for a in start]
    steps: list[tuple[float, list[float]]] = []
    theta, settled = 1.0, False
    while not settled:
        settled = all(abs(a - b) <= tolerance * max(s, b) for a, b, s in zip(reached, targets, scale, strict=True))
        if settled or len(steps) >= most_steps:
            break
        nearer = (1 + math.sqrt(1 + 4 * theta * theta)) / 2
        momentum, theta = (theta - 1) / nearer, nearer
        steps.append((momentum, [(a - b) / s for a, b, s in zip(ahead, targets, scale, strict=True)]))
        reached, ahead, moved = totals(steps[at:])
        settled = moved <= tolerance
        if len(steps) - at == block:
            now, at = materialize(now.select("tokens", "p", _stepped(F.col("state"), steps[at:], most).alias("state")), "rates"), len(steps)
    return steps, {"start": start, "targets": targets, "reached": reached, "steps": len(steps), "settled": settled}


def mix(documents: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, factors: dict[str, float] | None = None, keep: list[str] | None = None, max_labelled: int = 8000, most: float | None = None) -> tuple[DataFrame, dict]:
    """row (a struct of the columns in keep, by default all), tokens, p and rate for every row, and the report of fit_rates.

    Targets are either weights, shares of the present number of tokens, or
    factors of each domain's present expected tokens. Null and empty texts have
    no tokens; their rate follows their posterior like any other's, rows with one
    id or none too, and equal rows have equal rates. most bounds the rates from
    above. Rates are an expression over the text, so that rows pass without a
    shuffle.
    """
    models = fit_domains(documents, labels, max_labelled)
    post = materialize(domain_posteriors(documents, models, ["doc_id"]), "posteriors")
    sums = materialize(token_sums(post), "sums")
    r = sums.agg(*(F.sum(F.col("tokens") * F.col("p")[k]) for k in range(len(DOMAINS)))).first()
    have = [float(x or 0.0) for x in r]
    if weights is not None:
        share = sum(weights.values())
        targets = [sum(have) * weights.get(d, 0.0) / share for d in DOMAINS]
    else:
        targets = [h * (factors or {}).get(d, 1.0) for d, h in zip(DOMAINS, have, strict=True)]
    steps, report = fit_rates(sums, targets, most)
    rows = post if keep == ["doc_id"] else domain_posteriors(documents, models, keep)
    return rows.withColumn("rate", rate_after(steps, most)), report


def apply_rates(rated: DataFrame) -> DataFrame:
    """The rows as often as their rates say: the whole part always, once more with the probability of the rest, by a hash of the row.

    Equal rows fall alike; rates of 1 keep every row once, those of 0 none.
    """
    draw = F.pmod(F.xxhash64(F.col("row")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")
    return rated.select("row", F.explode(F.array_repeat(F.lit(True), copies.cast("int")))).select("row.*")
