"""Quality classification by hierarchical empirical Bayes.

A document's evidence is combined with what its host and its path are worth.
Hosts are shrunk toward the global mean and paths toward their host, the more
so the fewer documents they have; the strengths come from the variance between
and within groups (method of moments). A document's own evidence is taken out
of its site's before it is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftscan.llm import evidence
from driftscan.session import materialize


def _strength(groups: DataFrame, within: str | None = None) -> float:
    """Prior weight, in documents, of a group's mean: within-group variance over between-group variance, 1 to 10,000."""
    g = groups.withColumn("mean", F.col("total") / F.col("n"))
    r = g.agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("between"), F.sum(F.col("n") * F.col("n")).alias("n2")).first()
    if not r["n"] or r["groups"] < 2 or r["n"] <= r["groups"]:
        return 10_000.0
    noise = max(1e-9, (r["squares"] - r["between"]) / (r["n"] - r["groups"]))
    spread = (r["between"] - r["total"] ** 2 / r["n"] - (r["groups"] - 1) * noise) / (r["n"] - r["n2"] / r["n"])
    return min(10_000.0, max(1.0, noise / spread)) if spread > 0 else 10_000.0


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def combine_sites(scored: DataFrame, label: str = "quality") -> DataFrame:
    """scored (host, path and {label}_odds beside other columns) with {label}_host, {label}_path and {label}_score.

    Null hosts and paths are groups like others; a row that is the only one of its
    site has its host's posterior, and of a host's only one the global mean. Other
    columns pass, but for names that begin with two underscores. Only group tables are joined;
    they are written first, so that a hot host can be split in the join.
    """
    p = evidence.sigmoid(F.col(f"{label}_odds"))
    own = scored.withColumn("__p", p).withColumn("__h", F.struct("host")).withColumn("__s", F.struct("host", "path"))
    sites = materialize(own.groupBy("__h", "__s").agg(F.count("*").alias("n"), F.sum("__p").alias("total"), F.sum(F.col("__p") * F.col("__p")).alias("squares")), "sites")
    hosts = materialize(sites.groupBy("__h").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")), "hosts")
    whole = hosts.agg((F.sum("total") / F.sum("n")).alias("mean")).first()["mean"]
    mean, k_host, k_site = whole if whole is not None else 0.5, _strength(hosts), _strength(sites)
    table = sites.select("__h", "__s", F.col("n").alias("__n_site"), F.col("total").alias("__t_site")).join(hosts.select("__h", F.col("n").alias("__n_host"), F.col("total").alias("__t_host")), "__h").drop("__h")
    joined = own.drop("__h").join(materialize(table, "site_table"), "__s")
    host = (F.lit(k_host * mean) + F.col("__t_host") - F.col("__p")) / (F.lit(k_host) + F.col("__n_host") - 1)
    joined = joined.withColumn(f"{label}_host", host)
    path = (F.lit(k_site) * F.col(f"{label}_host") + F.col("__t_site") - F.col("__p")) / (F.lit(k_site) + F.col("__n_site") - 1)
    joined = joined.withColumn(f"{label}_path", path)
    score = evidence.sigmoid(F.col(f"{label}_odds") + _logit(F.col(f"{label}_path")) - _logit(F.lit(float(mean))))
    return joined.withColumn(f"{label}_score", score).drop("__p", "__s", "__n_site", "__t_site", "__n_host", "__t_host")


def classify(documents: DataFrame, labels: DataFrame, host: Column, path: Column, max_labelled: int = 8000) -> DataFrame:
    """doc_id, host, path and for quality and toxic: odds, host, path and score; kept where quality >= 0.5 and toxic < 0.5.

    One row for each row of documents; null texts are empty ones, null ids pass.
    The model is fitted on at most about max_labelled labelled documents.
    """
    models = evidence.fit(materialize(evidence.labelled_sample(documents, labels, max_labelled), "sample"), ("quality", "toxic"))
    marked = evidence.words_and_style(documents.select("doc_id", "text", host.alias("host"), path.alias("path")))
    odds = [evidence.log_odds(m).alias(f"{t}_odds") for t, m in models.items()]
    scored = materialize(marked.select("doc_id", "host", "path", *odds), "scored")
    out = combine_sites(combine_sites(scored, "quality"), "toxic")
    return out.withColumn("kept", (F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5))
