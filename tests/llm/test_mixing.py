import numpy as np
import pytest

from quillgraph.llm import mixing
from quillgraph.llm._common import cut

from .helpers import docs, labels, rows


def brute(t, p, targets, total, floor, ridge=1e-3):
    """Projected gradient in numpy, run far beyond convergence."""
    t, p = np.array(t, float), np.array(p, float)
    goal = np.array(targets) / sum(targets) * total
    scale = np.maximum(goal, 0.01 * total)
    r = np.full(len(t), max(1.0, floor))
    for _ in range(20_000):
        s = (r * t) @ p
        r = np.maximum(floor, r - 0.3 * (p @ ((s - goal) / scale) + ridge * (r - 1)))
    return r, (r * t) @ p, goal


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_rates_agree_with_brute_force(spark, floor):
    rng = np.random.default_rng(3)
    t = rng.integers(1, 500, 80)
    p = rng.dirichlet([0.3, 0.3, 0.3], 80)
    df = cut(spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "t long, p array<double>"))
    got = rows(mixing.fit_rates(df, [0.5, 0.3, 0.2], floor=floor).select("t", "p", "rate"))
    r, s, goal = brute([x[0] for x in got], [x[1] for x in got], [0.5, 0.3, 0.2], t.sum(), floor)
    mine = (np.array([x[2] for x in got]) * np.array([x[0] for x in got])) @ np.array([x[1] for x in got])
    assert np.abs(mine - s).max() < 0.01 * t.sum()
    if not floor:
        assert np.abs(np.array([x[2] for x in got]) - r).max() < 0.05
        assert np.abs(mine - goal).max() < 0.01 * t.sum()


def corpus(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "tiny", "words"], 30)) + "." for _ in range(40)]
    junk = [" ".join(rng.choice(["!!!", "$$$", "A%%", "###"], 30)) for _ in range(20)]
    return docs(spark, [*good, *junk, None, "", "  "], extra=True), labels(spark, [(i, int(i < 40), 0) for i in range(60)])


def test_classifier_and_mix(spark):
    df, lab = corpus(spark)
    out = {r.doc_id: r for r in mixing.mix(df, lab, {"1": 0.9, "0": 0.1}).collect()}
    assert len(out) == 63
    assert np.mean([out[i].domain == str(int(i < 40)) for i in range(60)]) > 0.95
    assert out[0].n_tokens == 30 and out[60].n_tokens == out[61].n_tokens == out[62].n_tokens == 0
    assert out[0].rate > 1 > out[50].rate >= 0
    grown = mixing.mix(df, lab, {"1": 0.9, "0": 0.1}, total="grow", floor=1.0)
    assert min(r.rate for r in grown.collect()) >= 1
    copied = mixing.copies(df, grown, floor=1)
    assert copied.columns == df.columns and {r.doc_id for r in copied.collect()} == set(range(63))


def test_copies_follow_the_rates_and_keep_unrated_rows(spark):
    df = docs(spark, ["a"] * 2000)
    rates = df.selectExpr("doc_id", "case when doc_id < 1000 then 2.25 when doc_id < 1990 then 0.5 end as rate").filter("rate is not null")
    n = {}
    for r in mixing.copies(df, rates).collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    assert 2150 < sum(v for k, v in n.items() if k < 1000) < 2350 and {v for k, v in n.items() if k < 1000} == {2, 3}
    assert 400 < sum(v for k, v in n.items() if 1000 <= k < 1990) < 600
    assert all(n[k] == 1 for k in range(1990, 2000))


def test_empty_tables_and_no_labels(spark):
    df, lab = corpus(spark)
    assert rows(mixing.mix(df.limit(0), lab, {"1": 1.0})) == []
    assert {r.rate for r in mixing.mix(df, lab.limit(0), {"1": 1.0}).collect()} == {1.0}


def brute_posteriors(df, lab):
    """Gaussian naive Bayes from scratch, in Python, on the same shares of characters and words."""
    import math
    import re

    def features(text):
        words, n = re.split(r"\s+", text or ""), max(len(text or ""), 1)
        shares = [sum(bool(re.match(g, c)) for c in text or "") / n for g in mixing.GROUPS.values()] + [len(set(words)) / len(words)]
        return [math.log(s + 0.001) for s in shares] + [math.log1p(len(words))]

    texts = {r.doc_id: r.text for r in df.collect()}
    known = [(str(r.quality), features(texts[r.doc_id])) for r in lab.collect() if r.doc_id in texts]
    score = {}
    for k in sorted({q for q, _ in known}):
        x = np.array([f for q, f in known if q == k])
        mean, var = x.mean(axis=0), np.maximum(x.var(axis=0), 0.01)
        score[k] = lambda f, m=mean, v=var, p=len(x) / len(known): math.log(p) - 0.5 * sum(math.log(2 * math.pi * b) + (a - c) ** 2 / b for a, b, c in zip(f, v, m))
    out = {}
    for i, t in texts.items():
        s = {k: f(features(t)) for k, f in score.items()}
        top = max(s.values())
        best = min(k for k in s if s[k] == top)
        out[i] = best, 1 / sum(math.exp(v - top) for v in s.values())
    return out


def test_posteriors_agree_with_brute_force(spark):
    df, lab = corpus(spark)
    df = df.unionByName(docs(spark, ["Mixed text, with !!! and $$$ 123.\nTwo lines; A B C", " lead and trail ", "word " * 200_000], start=100, extra=True))
    want = brute_posteriors(df, lab)
    for r in mixing.mix(df, lab, {"1": 0.9, "0": 0.1}).collect():
        assert r.domain == want[r.doc_id][0] and abs(r.posterior - want[r.doc_id][1]) < 1e-5, r.doc_id


@pytest.mark.parametrize("target", [0.1, 0.05, 0.02, 0.001])
def test_uneven_targets_settle(spark, target):
    rng = np.random.default_rng(1)
    p = np.where(rng.random(300) < 0.87, rng.beta(30, 1, 300), rng.beta(1, 30, 300))
    df = cut(spark.createDataFrame([(int(rng.integers(20, 900)), [float(x), float(1 - x)]) for x in p], "t long, p array<double>"))
    got = rows(mixing.fit_rates(df, [target, 1 - target], max_steps=100).selectExpr("t", "p", "rate"))
    mine = sum(np.array(r[1]) * r[0] * r[2] for r in got)
    assert abs(mine[0] / mine.sum() - target) < 0.01


def test_repeated_rows_and_ties_of_posteriors(spark):
    df, lab = corpus(spark)
    out = mixing.mix(df.unionAll(df), lab.unionAll(lab.selectExpr("doc_id", "1 - quality as quality", "toxic")), {"1": 0.5, "0": 0.5}).collect()
    assert len(out) == 126 and {r.domain for r in out} == {"0"}  # both domains hold the same rows, so each posterior is a half
    assert all(abs(r.posterior - 0.5) < 1e-6 for r in out)
