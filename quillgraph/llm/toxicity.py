"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and the words' beginnings of 4, 5 and 6 letters, each there or not.
P(grade > k) = sigmoid(w.x - theta_k): one weight vector for all grades, with ordered thresholds. The labels are
0 or 1; a toxic row's grade from 1 on follows how many marker features (strongly tied to toxic rows) it holds,
by the thirds of the toxic training rows. The expected severity is the sum over k of P(grade > k).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, cut, map_rows, read

_WORD = re.compile(r"[^\W\d_]+")
GRADES = 3
PREFIXES = (4, 5, 6)


def _hash(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) >> 1


def word_features(word: str) -> list[int]:
    return [_hash(word), *(_hash(word[:n] + "*") for n in PREFIXES if len(word) >= n)]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class OrdinalModel:
    """weights: of the features that count; thresholds rise. Without features every text has the same grades."""

    weights: dict[int, float]
    thresholds: list[float]

    def scorer(self):
        """A function from text to P(grade > k) for k from 0 on; it remembers words, up to a bound."""
        known: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> list[float]:
            hit: set[int] = set()
            for w in text_words(text):
                ids = known.get(w)
                if ids is None:
                    if len(known) > 300_000:
                        known.clear()
                    ids = known[w] = tuple(f for f in word_features(w) if f in self.weights)
                hit.update(ids)
            # In a fixed order, so that equal texts get equal sums in every process.
            z = sum(self.weights[f] for f in sorted(hit))
            return [float(1 / (1 + np.exp(np.clip(t - z, -60, 60)))) for t in self.thresholds]

        return score


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, n_grades: int, prior: float = 0.25, tolerance: float = 1e-3, max_rounds: int = 400, newcomers: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise mean log loss + prior / rows * |weights|, by proximal Newton steps on the features in play.

    With b = theta_y - z and a = theta_(y-1) - z a row's loss is softplus(-b) + softplus(a) - log(1 - exp(a - b)), which is convex, and
    whose last term keeps the thresholds apart. The steps end once the residual of the proximal gradient (by feature: how far the
    gradient is from what the penalty allows; by threshold: the gradient) is at most `tolerance` / rows; where max_rounds don't
    reach that, it is an error. The penalty falls to its value in stages, each begun where the last one ended, so that few features are in
    play at a time. A grade without rows gets the threshold of the next lower one that has rows.
    """
    there = np.unique(grades)
    if len(there) < 2:
        raise ValueError("an ordinal fit needs rows of two grades")
    n, y, k = len(rows), np.searchsorted(there, grades), len(there) - 1
    stages = [prior * 4.0**i / n for i in range(6, -1, -1)] if prior else [0.0]
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    at = np.array([i for r in rows for i in r], dtype=np.int64)
    low, high = y > 0, y < k  # rows that have a threshold below, above
    sigma = lambda v: 1 / (1 + np.exp(-np.clip(v, -500, 500)))

    def places(w, theta):
        z = np.bincount(row, w[at], minlength=n) if len(at) else np.zeros(n)
        b, a = np.full(n, np.inf), np.full(n, -np.inf)
        b[high], a[low] = theta[y[high]] - z[high], theta[y[low] - 1] - z[low]
        return b, a

    def loss(w, theta, l1):
        if len(theta) > 1 and np.diff(theta).min() <= 0:
            return np.inf
        b, a = places(w, theta)
        both = low & high
        parts = np.logaddexp(0, -b[high]).sum() + np.logaddexp(0, a[low]).sum() - np.log(-np.expm1(a[both] - b[both])).sum()
        return parts / n + l1 * np.abs(w).sum()

    w, rest = np.zeros(n_features), np.array([(y <= j).mean() for j in range(k)])
    theta = np.log(rest / (1 - rest))
    l1 = stages.pop(0)
    value = loss(w, theta, l1)
    for _ in range(max_rounds):
        b, a = places(w, theta)
        sb, sa = np.where(high, sigma(-b), 0.0), np.where(low, sigma(a), 0.0)
        apart = np.zeros(n)
        both = low & high
        apart[both] = 1 / np.expm1(b[both] - a[both])
        db, da = np.where(high, -sb - apart, 0.0), np.where(low, sa + apart, 0.0)
        fb, fa, h = sb * (1 - sb), sa * (1 - sa), apart * (1 + apart)
        gz, curve = -(db + da) / n, (fb + fa) / n
        gw = np.bincount(at, gz[row], minlength=n_features) if len(at) else np.zeros(n_features)
        gt = (np.bincount(y[high], db[high], minlength=k) + np.bincount(y[low] - 1, da[low], minlength=k)) / n
        off = np.where(w != 0, np.abs(gw + l1 * np.sign(w)), np.maximum(np.abs(gw) - l1, 0))
        residual = max(off.max(initial=0), np.abs(gt).max())
        if residual <= (tolerance / n if not stages else 0.05 * l1):
            if not stages:
                break
            l1 = stages.pop(0)
            value = loss(w, theta, l1)
            continue
        beyond = np.where(w == 0, np.abs(gw) - l1, 0.0)
        new = np.argsort(-beyond, kind="stable")[:newcomers]
        play = np.union1d(np.flatnonzero(w), new[beyond[new] > 0])
        size = len(play) + k
        hess = np.zeros((size, size))
        column = np.full(n_features, -1)
        column[play] = np.arange(len(play))
        inside = column[at] >= 0
        for first in range(0, n, 1000):  # the rows in play as a dense block at a time
            here = slice(*np.searchsorted(row, [first, first + 1000]))
            picked = inside[here]
            block = np.zeros((min(1000, n - first), size))
            np.add.at(block, (row[here][picked] - first, column[at[here][picked]]), 1.0)
            part = slice(first, first + len(block))
            x = block[:, : len(play)]
            hess[: len(play), : len(play)] += (x * curve[part, None]).T @ x
            for j in range(k):
                hess[: len(play), len(play) + j] -= x.T @ ((fb * (high & (y == j)) + fa * (low & (y == j + 1)))[part] / n)
        hess[len(play) :, : len(play)] = hess[: len(play), len(play) :].T
        for j in range(k):
            hess[len(play) + j, len(play) + j] = ((fb + h) * (high & (y == j)) + (fa + h) * (low & (y == j + 1))).sum() / n
            if j:
                hess[len(play) + j, len(play) + j - 1] = hess[len(play) + j - 1, len(play) + j] = -h[y == j].sum() / n
        g = np.concatenate([gw[play], gt])
        start = np.concatenate([w[play], theta])
        move = _newton_move(hess, g, start, np.where(np.arange(size) < len(play), l1, 0.0))
        slope = g @ move + l1 * (np.abs(start + move)[: len(play)].sum() - np.abs(w).sum())
        step = 1.0
        while True:
            nw, nt = w.copy(), theta + step * move[len(play) :]
            nw[play] += step * move[: len(play)]
            now = loss(nw, nt, l1)
            if now <= value + 0.01 * step * slope or step < 1e-12:
                break
            step /= 2
        w, theta, value = nw, nt, now
    else:
        raise RuntimeError(f"the ordinal fit did not settle in {max_rounds} rounds: residual {residual * n:.2e} of {tolerance:.2e} by row")
    full = [theta[max(np.searchsorted(there, j, side="right") - 1, 0)] if j < there[-1] else np.inf for j in range(n_grades - 1)]
    return w, np.array(full)


def _newton_move(hess: np.ndarray, g: np.ndarray, start: np.ndarray, l1: np.ndarray, at_once: int = 32) -> np.ndarray:
    """The move d that minimises g.d + d.hess.d / 2 + sum l1 |start + d|, by search over the signs of start + d.

    With signs held, the least point is a linear system's; on the way to it the first coordinate to reach zero leaves. Once all are
    in place those come in whose slope is beyond l1, several at once, or one where several hinder each other.
    """
    hess = hess + 1e-13 * max(np.diag(hess).max(), 1e-300) * np.eye(len(g))
    x, signs = start.copy(), np.sign(start)
    free = l1 == 0
    active = free | (x != 0)
    many = at_once
    for _ in range(20 * len(g) + 100):
        while True:
            on = np.flatnonzero(active)
            aim = start[on] - np.linalg.solve(hess[np.ix_(on, on)], (g + l1 * signs)[on] + hess[np.ix_(on, ~active)] @ (x - start)[~active])
            wrong = ~free[on] & (aim * signs[on] <= 0)
            if not wrong.any():
                x[on] = aim
                break
            far = np.abs(x[on][wrong]) / np.maximum(np.abs(x[on][wrong] - aim[wrong]), 1e-300)
            part = far.min()
            x[on] += part * (aim - x[on])
            gone = on[wrong][far <= part]
            x[gone], signs[gone], active[gone] = 0.0, 0.0, False
            if part == 0:
                many = 1
        slope = g + hess @ (x - start)
        beyond = np.where(active, 0.0, np.abs(slope) - l1)
        if beyond.max() <= 1e-9 * l1.max():
            break
        new = np.argsort(-beyond, kind="stable")[:many]
        new = new[beyond[new] > 1e-9 * l1.max()]
        many = at_once
        signs[new], active[new] = -np.sign(slope[new]), True
    return x - start


def fit_toxicity(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str = "doc_id", label_col: str = "toxic", max_toxic: int = 4000, max_clean: int = 8000, least_rows: int = 3, least_chi: float = 20.0) -> OrdinalModel:
    """Fitted on at most max_toxic and max_clean labelled rows, the least by hash of the id; equal texts count once.

    These bounds also bound what is broadcast and collected. A feature counts if `least_rows` of the sample hold it and its
    chi-squared part among the toxic ones is over `least_chi`; all such features do. Null ids and labels don't count. With one class
    only, or no row at all, the model has no feature and gives every text that class (clean if there is no row).
    """
    known = labels.select(col(label_id).cast("long").alias("_id"), (col(label_col).cast("int") > 0).cast("int").alias("_toxic")).dropna()
    order = lambda c, n: known.filter(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = order(1, max_toxic).unionAll(order(0, max_clean))
    texts = df.select(col(id_col).cast("long").alias("_id"), col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")

    def found(incoming):
        for toxic, text in incoming:
            feats = sorted({f for w in text_words(text) for f in word_features(w)})
            yield toxic, xxhash.xxh64_intdigest(text or "") >> 1, feats

    ddl, schema = "toxic int, digest long, feats array<long>", pa.schema([("toxic", pa.int32()), ("digest", pa.int64()), ("feats", pa.list_(pa.int64()))])
    sample = cut(map_rows(texts.select("_toxic", "_text"), found, schema, ddl, batch=500).dropDuplicates(["digest", "toxic"]))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        sure = 30.0 if n.get(1) else -30.0
        return OrdinalModel({}, [-sure] * GRADES)
    held = sample.select("toxic", F.explode("feats").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    expected = F.col("n") * (n[1] / (n[0] + n[1]))
    top = held.withColumn("chi", (F.col("a") - expected) * (F.col("a") - expected) / expected).filter(f"n >= {least_rows} and chi > {least_chi}").orderBy(F.desc("chi"), "f").collect()
    # Above least_chi: tied to toxicity, by the chi-squared part of the toxic rows, beyond chance.
    index = {r.f: i for i, r in enumerate(top)}
    # A marker is far more frequent among toxic rows: its rate there is over ten times that among clean ones.
    markers = {i for i, r in enumerate(top) if r.a >= 3 and (r.a + 0.1) / n[1] > 10 * (r.n - r.a + 0.1) / n[0]}

    def narrowed(incoming):
        for toxic, _, feats in incoming:
            yield toxic, [i for f in feats if (i := index.get(f)) is not None]

    got = map_rows(sample, narrowed, pa.schema([("toxic", pa.int32()), ("at", pa.list_(pa.int32()))]), "toxic int, at array<int>").collect()
    got = sorted(((r.toxic, list(r["at"])) for r in got), key=lambda r: (r[0], r[1]))  # the fit mustn't depend on the order of tasks
    strength = np.array([sum(i in markers for i in at) for toxic, at in got if toxic])
    steps = [np.quantile(strength, q) for q in (1 / 3, 2 / 3)]
    grades = np.array([1 + sum(sum(i in markers for i in at) > s for s in steps) if toxic else 0 for toxic, at in got])
    w, theta = fit_ordinal([at for _, at in got], grades, len(top), GRADES + 1)
    return OrdinalModel({r.f: float(w[i]) for i, r in enumerate(top) if w[i]}, [float(t) for t in theta])


def score_toxicity(df: DataFrame, model: OrdinalModel, id_col: str, text_col: str, reject: float = 0.2) -> DataFrame:
    """(doc_id, grade, severity, p_toxic, toxic) for each row; toxic where P(grade > 0) >= reject.

    grade: the likeliest, ties to the lower. Null and empty texts have no feature and get the thresholds' grades. Repeated
    rows stay repeated; other columns are ignored; an empty table gives no row. Texts are read whole, however long: the words of one
    text at a time are in memory.
    """

    def rows(incoming):
        score = model.scorer()
        for key, text in incoming:
            over = score(text)
            each = -np.diff([1, *over, 0])
            yield key, int(np.argmax(each)), round(sum(over), 6), round(over[0], 6), over[0] >= reject

    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("severity", pa.float64()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, "doc_id long, grade int, severity double, p_toxic double, toxic boolean")


def drop_toxic(df: DataFrame, model: OrdinalModel, text_col: str, reject: float = 0.2) -> DataFrame:
    """df without the rows that score_toxicity would call toxic; all its columns stay.

    Null and empty texts count as empty; rows with a null id stay if their text isn't toxic; repeated rows share their fate; an
    empty table stays empty.
    """

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for texts in batches:
            yield texts.map(lambda t: score(t)[0] < reject).astype(bool)

    return df.filter(clean(F.coalesce(col(text_col).cast("string"), F.lit(""))))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels"), "doc_id", "text"), "doc_id", "text")
