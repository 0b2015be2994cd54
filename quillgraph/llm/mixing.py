"""Mixing sources to target weights, by DataFrame functions alone.

A Gaussian naive Bayes classifier, fitted on a labelled table, gives each document posteriors p over
domains from its character statistics. Nonnegative rates r of documents with t tokens then minimise

    1/2 sum_k (S_k - T_k)^2 / (T_k T) + ridge/2 sum_d t_d/T (r_d - 1)^2,   S_k = sum_d r_d t_d p_dk

by projected gradient steps, scaled by the curvature of the documents above the floor. A document's gradient, divided by its share
t/T, is p.pull + ridge (r - 1) with pull_k = (S_k - T_k) / (T_k T), so the curvature is a few sums of K by K numbers, its scaled and
projected step is r = max(floor, 1 - p.m / ridge) with K multipliers m, and a step is one aggregate over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log, pi

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, cut, fresh, read

#: Character groups whose shares of a text are features.
GROUPS = {"upper": "[A-Z]", "digit": "[0-9]", "marks": "[!#$%&*+<=>@^_|~]", "stops": "[.,;:?]", "line": "\n"}


FEATURES = [*GROUPS, "distinct", "words"]


def with_features(df: DataFrame, text_col: str) -> DataFrame:
    """df with a column _t of words and one for each feature: log(share + 0.001) of each group, and of the distinct among the words, and log(1 + words)."""
    text = F.col("_safe")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    out = df.withColumn("_safe", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_words", F.split("_safe", r"\s+"))
    shares = {k: F.regexp_count(text, F.lit(v)) / n for k, v in GROUPS.items()}
    shares["distinct"] = F.size(F.array_distinct("_words")) / F.size("_words").cast("double")
    logs = {k: F.log(v + 0.001) for k, v in shares.items()} | {"words": F.log1p(F.size("_words").cast("double"))}
    tokens = (F.size("_words") - (F.substring("_safe", 1, 1).rlike(r"^\s") | (F.col("_safe") == "")).cast("int") - F.substring("_safe", -1, 1).rlike(r"^\s").cast("int")).cast("long")
    return out.withColumns({"_t": F.greatest(tokens, F.lit(0).cast("long"))} | {f"_f_{k}": c for k, c in logs.items()}).drop("_safe", "_words")


@dataclass(frozen=True)
class DomainModel:
    """priors[k], means[k][feature] and variances[k][feature] of each domain k, ordered by name."""

    domains: list[str]
    priors: list[float]
    means: list[dict[str, float]]
    variances: list[dict[str, float]]

    def with_posteriors(self, df: DataFrame) -> DataFrame:
        """df(_f_...) with a column p, array<double>, summing to one."""
        scores = {}
        for k, (prior, mean, var) in enumerate(zip(self.priors, self.means, self.variances, strict=True)):
            s = F.lit(log(prior))
            for f in FEATURES:
                d = F.col(f"_f_{f}") - mean[f]
                s = s - F.lit(0.5 * log(2 * pi * var[f])) - d * d / (2 * var[f])
            scores[f"_s_{k}"] = s
        names = list(scores)
        top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
        out = df.withColumns(scores).withColumn("_top", top).withColumns({n: F.exp(F.col(n) - F.col("_top")) for n in names})
        out = out.withColumn("_all", sum((F.col(n) for n in names), F.lit(0.0)))
        return out.withColumn("p", F.array(*(F.col(n) / F.col("_all") for n in names))).drop("_top", "_all", *names)


def fit_domains(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, max_train: int = 20_000) -> DomainModel:
    """Fitted on at most max_train labelled rows (the least by hash of the id); that bound also bounds what is broadcast.

    Rows with a null id, null label or without document don't count. Repeated documents count as often as they are there.
    """
    chosen = labels.select(col(label_id).cast("long").alias("_id"), col(label_col).cast("string").alias("_domain")).dropna().orderBy(F.xxhash64("_id"), "_id", "_domain").limit(max_train)
    texts = df.select(col(id_col).cast("long").alias("_id"), col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
    x = [f"_f_{k}" for k in FEATURES]
    rows = (
        with_features(texts, "_text")
        .groupBy("_domain")
        .agg(F.count("*").alias("n"), *(F.avg(k).alias(f"m{k}") for k in x), *(F.var_pop(k).alias(f"v{k}") for k in x))
        .orderBy("_domain")
        .collect()
    )
    if not rows:
        raise ValueError("no labelled document to fit domains on")
    total = sum(r.n for r in rows)
    return DomainModel([r["_domain"] for r in rows], [r.n / total for r in rows], [{k: r[f"m_f_{k}"] for k in FEATURES} for r in rows], [{k: max(r[f"v_f_{k}"], 0.01) for k in FEATURES} for r in rows])


def fit_rates(df: DataFrame, targets: list[float], total: float | None = None, floor: float = 0.0, ridge: float = 1e-3, tolerance: float = 1e-3, max_steps: int = 100) -> DataFrame:
    """df(t long, p array<double>, ...) with a column rate, fitted to shares `targets` of `total` expected tokens.

    total: of all domains; by default what is there, and "grow" is the least total at which no domain has to shrink.
    floor: least rate, 0 or more. ridge: over 0. An empty table comes back empty; documents without tokens keep rate 1.
    df must be cheap to read again (cut): it is scanned once a step, and nothing is written between steps.
    The steps end once the projected gradient, averaged over tokens, is at most `tolerance`; where max_steps don't reach
    that, it is an error. A step that would lower the dual of the problem is halved.
    """
    k = len(targets)
    t, p = F.col("t"), [F.col("p")[j] for j in range(k)]
    sums = lambda columns: [float(x or 0) for x in df.agg(*(F.sum(t * c) for c in columns)).first()]
    dot = lambda numbers: sum((x * F.lit(float(w)) for x, w in zip(p, numbers, strict=True)), F.lit(0.0))
    start = max(1.0, floor)
    now = [start * s for s in sums(p)]
    have = sum(now)
    weight = sum(w for w, s in zip(targets, now, strict=True) if s > 0)
    if not have or not weight:
        return df.withColumn("rate", F.lit(start).cast("double"))
    share = [w / weight if s > 0 else 0.0 for w, s in zip(targets, now, strict=True)]
    if total == "grow":
        total = max(s / w for s, w in zip(now, share, strict=True) if w)
    total = total or have
    goal = [w * total for w in share]
    scale = np.array([max(g, 0.01 * total) for g in goal])
    unit = 1 / (max(s / c for s, c in zip(now, scale, strict=True)) + ridge)  # the step by which the projected gradient is measured
    rate_of = lambda m: F.greatest(F.lit(float(floor)), 1 - dot(m) / ridge)

    def at(m: np.ndarray):
        """Rates of the multipliers m: sums S, curvature of what is above the floor, and the value of the dual."""
        rate = rate_of(m)
        free = F.when(rate > floor, 1.0).otherwise(0.0)
        got = sums([*(rate * x for x in p), *(free * p[i] * p[j] for i in range(k) for j in range(i, k)), (rate - 1) * (rate - 1)])
        bend = np.zeros((k, k))
        bend[np.triu_indices(k)] = got[k:-1]
        s = np.array(got[:k])
        return s, bend + np.triu(bend, 1).T, m @ (s - goal) - (scale * m * m).sum() / 2 + ridge * got[-1] / 2

    m = np.zeros(k)
    s, bend, value = at(m)
    for _ in range(max_steps):
        pull = (s - goal) / scale
        rate = rate_of(m)
        (left,) = sums([F.abs(F.greatest(F.lit(float(floor)), rate - unit * (dot(pull) + ridge * (rate - 1))) - rate) / unit])
        if left <= tolerance * have:
            break
        off = s - goal - scale * m
        move = np.linalg.solve(bend / ridge + np.diag(scale), off)
        part = 1.0
        while True:
            ahead = at(m + part * move)
            if ahead[2] >= value + 1e-4 * part * (off @ move) or part < 1e-9:
                break
            part /= 2
        m, (s, bend, value) = m + part * move, ahead
    else:
        raise RuntimeError(f"rates did not settle in {max_steps} steps: the projected gradient is {left / have:.6f}")
    return df.withColumn("rate", F.when(t > 0, rate_of(m)).otherwise(F.lit(start)))


def mix(df: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", max_train: int = 20_000, **options) -> DataFrame:
    """(doc_id, n_tokens, domain, posterior, rate) for each row of df; domain is the likeliest, ties to the first by name.

    Domains of the labels that `targets` lacks have target 0. Null texts count as empty. Repeated rows are
    documents of their own. Very long texts are read whole. Other columns of df are ignored, whatever their names. Without a
    labelled document there is one domain, "", and every rate is the least that `floor` allows from 1 on; an empty table gives no row.
    """
    docs = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("_text"))
    ready = with_features(docs, "_text").drop("_text")
    try:
        model = fit_domains(df, labels, id_col, text_col, label_id, label_col, max_train)
        names, ready = model.domains, model.with_posteriors(ready)
    except ValueError:
        names, ready = [""], ready.withColumn("p", F.array(F.lit(1.0)))
    scored = cut(ready.select("doc_id", F.col("_t").alias("t"), "p"))
    rated = fit_rates(scored, [float(targets.get(n, 0)) for n in names], **options)
    top = F.array_max("p")
    return rated.select("doc_id", F.col("t").alias("n_tokens"), F.array(*map(F.lit, names))[F.array_position("p", top).cast("int") - 1].alias("domain"), F.round(top, 6).alias("posterior"), F.round("rate", 6).alias("rate"))


def copies(df: DataFrame, rates: DataFrame, id_col: str = "doc_id", floor: int = 0) -> DataFrame:
    """df with each document as often as its rate says: the whole part, and once more if a hash of the id is below the rest.

    rates: (doc_id, rate); of several rows of one id the highest counts. Rows whose id has no rate, or is null, stay as they are.
    Texts don't matter, and repeated rows are copied each; an empty table stays empty.
    """
    key, times = fresh(df, "_key"), fresh(df, "_n")
    n = F.floor("rate") + F.when(F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1_000_000)) / 1e6 < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    chosen = rates.groupBy("doc_id").agg(F.max("rate").alias("rate")).select(F.col("doc_id").alias(key), F.greatest(n, F.lit(floor)).cast("int").alias(times)).filter(F.col(times) != 1)
    out = df.join(chosen, col(id_col).cast("long") == F.col(key), "left")
    return out.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.coalesce(times, F.lit(1))))).select(*(col(c) for c in df.columns))


#: Shares of expected tokens by the label `quality`.
TARGETS = {"1": 0.75, "0": 0.25}


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), TARGETS)
