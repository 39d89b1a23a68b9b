"""Quality classifier: document evidence and empirical Bayes over sites and paths."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm import statistics as st
from basketloom.sources.stage import settle

FEATURES = ["n_words", "word_length", "symbol_rate", "upper_rate", "mark_rate", "distinct_rate"]


def document_features(docs: DataFrame, keys: list[str]) -> DataFrame:
    return st.base_counts(docs, keys).select(
        *keys,
        "n_words",
        st.rate("word_chars", "n_words").alias("word_length"),
        st.rate("n_symbols", "n_words").alias("symbol_rate"),
        st.rate("n_upper", "word_chars").alias("upper_rate"),
        st.rate("n_marks", "n_words").alias("mark_rate"),
        st.rate("n_distinct", "n_words").alias("distinct_rate"),
    )


class Model:
    """Thresholds and log-likelihood ratios of the document classifier, and the pooled priors."""

    def __init__(self, cuts: dict[str, list[float]], ratios: dict[str, list[float]], prior: float):
        self.cuts, self.ratios, self.prior = cuts, ratios, prior

    def evidence(self) -> Column:
        """Sum of the log-likelihood ratios of good against bad.

        Never null, and said so: for a nullable column the planner would add a
        null test to the scan that computes all statistics once more.
        """
        parts = [
            F.get(F.array(*[F.lit(r) for r in self.ratios[f]]), st.bin_of(F.col(f), self.cuts[f])) for f in self.cuts
        ]
        return F.coalesce(sum(parts[1:], parts[0]), F.lit(0.0)) if parts else F.lit(0.0)


def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _chance(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def fit(rows: DataFrame, label: str = "good") -> Model:
    """Naive Bayes over binned statistics; counts per bin are all that reaches the driver."""
    cuts = st.thresholds(rows, FEATURES, label)
    cells = F.array(*[F.struct(F.lit(f).alias("f"), st.bin_of(F.col(f), cuts[f]).alias("bin")) for f in FEATURES])
    counts = rows.select(label, F.explode(cells).alias("b")).groupBy("b.f", "b.bin", label).count().collect()
    table = {f: [[1.0, 1.0] for _ in range(len(cuts[f]) + 1)] for f in FEATURES}
    for f, b, y, n in counts:
        table[f][b][y] += n
    ratios, totals = {}, [0.0, 0.0]
    for f in FEATURES:
        totals = [sum(c[y] for c in table[f]) for y in (0, 1)]
        ratios[f] = [log(c[1] / totals[1]) - log(c[0] / totals[0]) for c in table[f]]
    prior = totals[1] / (totals[0] + totals[1])
    return Model(cuts, ratios, prior)


def _strength(groups: DataFrame, own: str, above: str) -> float:
    """Pseudo-counts of a level's Beta prior, by the method of moments.

    The spread of the group means around the level above, beyond what the
    binomial spread of groups of their size explains; few differences give a
    strong prior. One row reaches the driver.
    """
    row = groups.agg(
        F.sum(F.col("n") * (F.col(own) / F.col("n") - F.col(above)) ** 2).alias("spread"),
        F.sum(F.col(above) * (1 - F.col(above))).alias("noise"),
        F.sum(F.col("n") * F.col(above) * (1 - F.col(above))).alias("scale"),
    ).first()
    extra = ((row["spread"] or 0.0) - (row["noise"] or 0.0)) / max(row["scale"] or 0.0, 1e-12)
    return min(1e6, max(1.0, 1 / max(extra, 1e-6) - 1))


def site_posteriors(rows: DataFrame, prior: float, path: str) -> tuple[DataFrame, DataFrame]:
    """Posterior share of good documents per host and per path of a host.

    ``rows`` has source, ``path`` and value: the label, or the chance of an
    unlabelled document. Sums combine before the shuffle, so a host with a
    third of all rows is one row per task.
    """
    paths = settle(rows.groupBy("source", path).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("good")), "paths")
    hosts = paths.groupBy("source").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("top", F.lit(prior))
    m = _strength(hosts, "good", "top")
    hosts = settle(hosts.select("source", ((F.col("good") + m * prior) / (F.col("n") + m)).alias("host_posterior")), "hosts")
    joined = paths.join(hosts.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
    k = _strength(joined, "good", "host_posterior")
    posterior = (F.col("good") + k * F.col("host_posterior")) / (F.col("n") + k)
    return hosts, settle(joined.select("source", path, "host_posterior", posterior.alias("path_posterior")), "posteriors")


def _scored(rows: DataFrame, posteriors: DataFrame, model: Model, path: str, least: float) -> DataFrame:
    named = posteriors.withColumnsRenamed({"source": "__s", path: "__p"})
    same = F.col("source").eqNullSafe(F.col("__s")) & F.col(path).eqNullSafe(F.col("__p"))
    shrunk = F.least(F.greatest("path_posterior", F.lit(1e-6)), F.lit(1 - 1e-6))
    return (
        rows.join(named, same)
        .drop("__s", "__p")
        .withColumn("p_good", _chance(_logit(shrunk) + F.col("evidence")))
        .withColumn("kept", F.col("p_good") >= least)
    )


def _prepared(docs: DataFrame, labels: DataFrame, path: str) -> tuple[DataFrame, Model, DataFrame]:
    stats = settle(document_features(docs, ["doc_id", "source", path]), "features")
    marks = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    known = settle(stats.dropDuplicates(["doc_id"]).join(marks, "doc_id"), "labelled")
    model = fit(known)
    scored = stats.withColumn("evidence", model.evidence())
    chance = _chance(F.lit(log(model.prior / (1 - model.prior))) + F.col("evidence"))
    rows = scored.join(marks, "doc_id", "left").withColumn("value", F.coalesce(F.col("good").cast("double"), chance))
    return scored, model, site_posteriors(rows, model.prior, path)[1]


def classify(docs: DataFrame, labels: DataFrame, path: str = "lang", least: float = 0.5) -> DataFrame:
    """(doc_id, source, path, evidence, host_posterior, path_posterior, p_good, kept) per row.

    A document's chance is the posterior of its path times its own evidence, in
    log-odds. Host posteriors shrink toward the global share, path posteriors
    toward their host's, the more the fewer documents a site has. Documents
    need doc_id, text, source and ``path``; labels doc_id and quality (0, 1).
    Null hosts and paths are sites of their own; null or blank texts have the
    evidence of empty ones. A doc_id with several labels counts as its lowest.
    Without labels every document has the same evidence and is kept.
    """
    scored, model, posteriors = _prepared(docs, labels, path)
    out = _scored(scored, posteriors, model, path, least)
    return out.select("doc_id", "source", path, "evidence", "host_posterior", "path_posterior", "p_good", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, path: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`classify` keeps.

    Texts are read again rather than shuffled.
    """
    _, model, posteriors = _prepared(docs, labels, path)
    own = docs.columns
    rows = document_features(docs.select(F.struct("*").alias("__row"), "source", path, "text"), ["__row", "source", path])
    out = _scored(rows.withColumn("evidence", model.evidence()), posteriors, model, path, least)
    return out.filter("kept").select(*[F.col("__row")[c].alias(c) for c in own])
