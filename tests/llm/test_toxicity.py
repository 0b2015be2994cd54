import re

import numpy as np

from quillgraph.llm import toxicity

from .helpers import docs, labels, rows


def corpus(n=400, seed=0):
    rng = np.random.default_rng(seed)
    clean = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(300)]
    bad = ["zorgish", "zorgly", "wimble", "quaxing"]
    texts, toxic = [], []
    for i in range(n):
        ws = rng.choice(clean, rng.integers(5, 80)).tolist()
        hit = i % 5 == 0
        for _ in range(rng.integers(1, 6) if hit else 0):
            ws.insert(int(rng.integers(len(ws))), str(rng.choice(bad)))
        texts.append(" ".join(ws))
        toxic.append(int(hit))
    return texts, toxic


def test_held_out_accuracy_and_rising_severity(spark):
    texts, toxic = corpus()
    df = docs(spark, texts, extra=True)
    model = toxicity.fit_toxicity(df, labels(spark, [(i, 1, toxic[i]) for i in range(280)]), "doc_id", "text")
    assert model.thresholds == sorted(model.thresholds)
    out = {r.doc_id: r for r in toxicity.score_toxicity(df, model, "doc_id", "text").collect()}
    held = range(280, 400)
    assert np.mean([out[i].toxic == bool(toxic[i]) for i in held]) > 0.97
    many, one = "zorgish wimble quaxing zorgly " * 3, "wimble abc"
    score = model.scorer()
    assert sum(score(many)) > sum(score(one)) > sum(score("abc abd"))
    kept = toxicity.drop_toxic(df, model, "text")
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if not r.toxic}


def test_gradient_of_the_ordinal_loss():
    rows_ = [[0], [1], [0, 1], [], [2], [0, 2]] * 10
    grades = np.array([0, 1, 1, 0, 2, 2] * 10)
    w, theta = toxicity.fit_ordinal(rows_, grades, 3, 3, prior=0.0)
    z = np.array([w[r].sum() for r in rows_])
    p = lambda w, theta: -np.log(np.diff(np.c_[np.zeros(60), 1 / (1 + np.exp(-(theta[None] - np.array([w[r].sum() for r in rows_])[:, None]))), np.ones(60)], axis=1)[np.arange(60), grades]).mean()
    base = p(w, theta)
    for d in np.eye(3):
        assert p(w + 0.05 * d, theta) > base - 1e-3 and p(w - 0.05 * d, theta) > base - 1e-3
    assert z[4] > z[1] > z[3] - 1e-9


def test_nulls_ties_empty_tables_and_single_class(spark):
    texts, toxic = corpus(60)
    df = docs(spark, [*texts, None, "", "zorgish " * 50_000])
    lab = labels(spark, [(i, 1, t) for i, t in enumerate(toxic)] + [(0, 1, toxic[0])])
    model = toxicity.fit_toxicity(df, lab, "doc_id", "text")
    out = {r[0]: r for r in rows(toxicity.score_toxicity(df.unionAll(df), model, "doc_id", "text"))}
    assert len(out) == 63 and not out[60][4] and not out[61][4] and out[62][4] and out[60][1:] == out[61][1:]
    assert rows(toxicity.score_toxicity(df.limit(0), model, "doc_id", "text")) == []
    for none in (lab.limit(0), lab.filter("toxic = 0")):
        clean = toxicity.fit_toxicity(df, none, "doc_id", "text")
        assert not any(r[4] for r in rows(toxicity.score_toxicity(df, clean, "doc_id", "text")))


def brute_loss(rows_, grades, w, theta, prior):
    edges = np.concatenate([[-np.inf], theta, [np.inf]])
    z = np.array([sum(w[i] for i in r) for r in rows_])
    sigma = lambda v: 1 / (1 + np.exp(-v))
    p = sigma(edges[grades + 1] - z) - sigma(edges[grades] - z)
    return -np.log(p).mean() + prior / len(rows_) * np.abs(w).sum()


def test_the_fit_is_a_minimum_and_settles(spark):
    rng = np.random.default_rng(2)
    rows_ = [sorted(rng.choice(12, rng.integers(0, 5), replace=False).tolist()) for _ in range(150)]
    grades = np.array([min(3, max(0, sum(i < 4 for i in r) + int(rng.integers(-1, 2)))) for r in rows_])
    w, theta = toxicity.fit_ordinal(rows_, grades, 12, 4, prior=1.0, tolerance=1e-7)
    least = brute_loss(rows_, grades, w, theta, 1.0)
    assert (w == 0).any() and (np.diff(theta) > 0).all()
    for d in [*np.eye(15), *rng.normal(size=(50, 15))]:
        for size in (1e-3, -1e-3, 0.1, -0.1):
            moved = theta + size * d[12:]
            if (np.diff(moved) > 0).all():
                assert brute_loss(rows_, grades, w + size * d[:12], moved, 1.0) >= least - 1e-12
    try:
        toxicity.fit_ordinal(rows_, grades, 12, 4, prior=1.0, max_rounds=2)
        raise AssertionError("two rounds can't do")
    except RuntimeError as e:
        assert "did not settle" in str(e)


def test_grades_without_rows_and_one_grade():
    rows_, grades = [[0], [], [0, 1], [1], [], [0]] * 5, np.array([3, 0, 3, 0, 3, 0] * 5)
    w, theta = toxicity.fit_ordinal(rows_, grades, 2, 4)
    assert theta[0] == theta[1] == theta[2]
    try:
        toxicity.fit_ordinal(rows_, grades * 0, 2, 4)
        raise AssertionError("one grade has no threshold")
    except ValueError:
        pass


def test_features_grades_and_scores_agree_with_brute_force(spark):
    texts, toxic = corpus(300, 7)
    df = docs(spark, texts)
    model = toxicity.fit_toxicity(df, labels(spark, [(i, 1, t) for i, t in enumerate(toxic)]), "doc_id", "text")
    seen, sample = set(), []
    for t, y in zip(texts, toxic):
        if (t, y) not in seen:
            seen.add((t, y))
            sample.append((y, {f for w in set(re.findall(r"[^\W\d_]+", t.lower())) for f in [w, *(w[:n] + "*" for n in (4, 5, 6) if len(w) >= n)]}))
    n = [sum(y == k for y, _ in sample) for k in (0, 1)]
    held = {}
    for y, feats in sample:
        for f in feats:
            held.setdefault(f, [0, 0])[y] += 1
    part = {f: (b - (a + b) * n[1] / sum(n)) ** 2 / ((a + b) * n[1] / sum(n)) for f, (a, b) in held.items()}
    chosen = sorted(f for f in held if sum(held[f]) >= 3 and part[f] > 20)
    markers = {f for f in chosen if held[f][1] >= 3 and (held[f][1] + 0.1) / n[1] > 10 * (held[f][0] + 0.1) / n[0]}
    strength = np.array([len(markers & feats) for y, feats in sample if y])
    cuts = [np.quantile(strength, q) for q in (1 / 3, 2 / 3)]
    grades = np.array([1 + sum(len(markers & feats) > c for c in cuts) if y else 0 for y, feats in sample])
    rows_ = [[i for i, f in enumerate(chosen) if f in feats] for _, feats in sample]
    theirs = np.array([model.weights.get(toxicity._hash(f), 0.0) for f in chosen])
    assert set(model.weights) <= {toxicity._hash(f) for f in chosen}
    w, theta = toxicity.fit_ordinal(rows_, grades, len(chosen), 4, tolerance=1e-6)
    assert brute_loss(rows_, grades, theirs, np.array(model.thresholds), 0.25) - brute_loss(rows_, grades, w, theta, 0.25) < 1e-5
    score = model.scorer()
    for t, (_, feats) in zip(texts, sample):
        z = sum(model.weights.get(toxicity._hash(f), 0.0) for f in feats)
        assert np.allclose(score(t), [1 / (1 + np.exp(c - z)) for c in model.thresholds], atol=1e-9)
