import random

import numpy as np
import pytest
import xxhash

from quillgraph.llm import simhash
from quillgraph.llm._common import cut

from .helpers import docs, rows


M64 = (1 << 64) - 1


def mixed(h, nth):
    """The nth number of SplitMix64 from h on; h itself for 0."""
    if nth:
        h = h + nth * 0x9E3779B97F4A7C15 & M64
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & M64
        h = (h ^ h >> 27) * 0x94D049BB133111EB & M64
        h ^= h >> 31
    return h


def brute_prints(text, words=4, prints=1):
    ws = "".join(c.lower() if c.isascii() else c for c in (text or ""))
    ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", ws) if w]
    if not ws:
        return [0] * prints
    sh = [" ".join(ws[i : i + words]) for i in range(max(1, len(ws) - words + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return [sum(1 << b for b in range(64) if 2 * sum(mixed(h, k) >> b & 1 for h in hs) > len(hs)) for k in range(prints)]


def brute_print(text):
    return brute_prints(text)[0]


def components(prints, t):
    """prints: a fingerprint, or a list of them of which one has to be near, by document."""
    root = {k: k for k in prints}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    keys = sorted(prints)
    of = {k: p if isinstance(p, list) else [p] for k, p in prints.items()}
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if any((x ^ y).bit_count() <= t for x, y in zip(of[a], of[b], strict=True)):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def corpus():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(400)] + ["É", "ß", "\u00a0x", "A", "B"]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 120))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for b in base[:15]:
        for _ in range(6):
            c = list(b)
            c[rng.randrange(len(c))] = rng.choice(words)
            texts.append("\n ".join(c))
    return texts + [None, "", " \t\n", "one", "ONE", texts[3], texts[3].upper()]


@pytest.mark.parametrize("cap", [2048, 1])
def test_components_agree_with_all_pairs(spark, cap):
    texts = corpus()
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts, extra=True), cell_cap=cap).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == prints
    want = components(prints, 4)
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(texts) - 20


@pytest.mark.parametrize("cap", [8192, 1])
def test_any_of_several_fingerprints_links(spark, cap):
    texts = corpus()
    df = docs(spark, texts, extra=True)
    got = {r.doc_id: r for r in simhash.near_duplicates(df, words=5, prints=3, cell_cap=cap).collect()}
    prints = {i: brute_prints(t, 5, 3) for i, t in enumerate(texts)}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == {i: p[0] for i, p in prints.items()}
    want = components(prints, 4)
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(set(components({i: p[0] for i, p in prints.items()}, 4).values()))
    assert simhash.near_duplicates(df.limit(0), prints=3).count() == 0


def _balls(n, rng):
    out = []
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            out.append(x)
    return out


@pytest.mark.parametrize(("t", "groups", "cap"), [(4, 6, 2048), (4, 7, 2048), (4, 8, 2048), (2, 4, 2048), (4, 6, 2)])
def test_links_of_raw_fingerprints(spark, t, groups, cap):
    prints = dict(enumerate(sorted(set(_balls(40, random.Random(t))))))
    df = cut(spark.createDataFrame([(simhash._signed(x),) for x in prints.values()], "fp long"))
    found = {r.u % (1 << 64): r.root % (1 << 64) for r in simhash.connected(simhash.near_links(df, t, cap, groups)).collect()}
    want = components(prints, t)
    mine = {}
    for i, x in prints.items():
        mine.setdefault(found.get(x, x), set()).add(i)
    theirs = {}
    for i, r in want.items():
        theirs.setdefault(r, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_connected_on_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1001 + i) for i in range(500)]
    big = [(5000 + i, 5000) for i in range(3000)]
    want = {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1501)} | {5000 + i: 5000 for i in range(3000)}
    edges = spark.createDataFrame([*chain, *hub, *big, (5, 5)], "u long, v long").repartition(7)
    for per_task in (1_000_000, 1):
        assert dict(rows(simhash.connected(edges, per_task=per_task))) == want
    assert rows(simhash.connected(spark.createDataFrame([], "u long, v long"))) == []


def test_keep_first_nulls_and_repeats(spark):
    texts = corpus()
    df = docs(spark, texts, extra=True)
    odd = df.filter("doc_id = 2").selectExpr("cast(null as long) as doc_id", *[f"`{c}`" for c in df.columns[1:]])
    kept = simhash.keep_first(df.unionAll(df.filter("doc_id < 3")).unionAll(odd))
    want = components({i: brute_print(t) for i, t in enumerate(texts)}, 4)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == df.columns and ids.count(None) == 1
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert rows(simhash.keep_first(df.limit(0))) == []


def test_stars():
    u, v = simhash._stars(np.array([1, 2, 9]), np.array([2, 3, 8]))
    assert dict(zip(u.tolist(), v.tolist())) == {2: 1, 3: 1, 9: 8}


def edited(rng, pairs):
    """Texts of 300 words and copies with words changed so that five-word similarity lies between about 0.6 and 0.95."""
    texts = []
    for i in range(pairs):
        base = ["w%d" % rng.randrange(5000) for _ in range(300)]
        copy = list(base)
        for at in rng.sample(range(0, 300, 6), 2 + i % 14):
            copy[at] = "new%d" % rng.randrange(5000)
        texts += [" ".join(base), " ".join(copy)]
    return texts


def jaccard(a, b, words=5):
    x, y = ({tuple(t.split()[i : i + words]) for i in range(len(t.split()) - words + 1)} for t in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("cap", [8192, 2])
def test_share_links_all_pairs_from_there_on(spark, cap):
    texts = edited(random.Random(7), 280)
    texts += [texts[0] + " tail%d" % i for i in range(5)] + [None, "", "one", "two words"]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, texts, extra=True), words=5, prints=4, share=0.8, cell_cap=cap).collect()}
    near = {i: jaccard(texts[i], texts[i + 1]) for i in range(0, 560, 2)}
    linked = {i for i in near if got[i] == got[i + 1]}
    wanted = {i for i, x in near.items() if x >= 0.8}
    assert len(wanted) > 100 and len(wanted - linked) <= len(wanted) // 100
    prints = {i: brute_prints(texts[i], 5, 4) for i in range(560)}
    close = {i for i in near if any((x ^ y).bit_count() <= 4 for x, y in zip(prints[i], prints[i + 1], strict=True))}
    assert linked <= wanted | close and len(set(near) - wanted - close) > 50
    assert {got[560 + i] for i in range(5)} == {0} and got[565] == got[566] and got[567] == 567 and got[568] == 568
    assert simhash.near_duplicates(docs(spark, texts).limit(0), words=5, prints=4, share=0.8).count() == 0


def test_pipeline_drops_edited_copies(spark):
    import corpus_pipeline

    texts = edited(random.Random(8), 140)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark, texts), "").collect()}
    wanted = [i for i in range(0, 280, 2) if jaccard(texts[i], texts[i + 1]) >= 0.8]
    assert len(wanted) > 50 and sum(i + 1 in kept for i in wanted) <= 1
    assert kept >= set(range(0, 280, 2))


def test_a_large_group_of_edited_copies(spark):
    """Copies of one text with 1 to 30 words changed: all pairs at 0.8 or more are connected, and nothing else, whatever the blocks."""
    rng = random.Random(11)
    base = ["w%d" % rng.randrange(5000) for _ in range(200)]
    texts = []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(200), 1 + i % 6 if i % 4 else 30):
            copy[at] = "n%d" % rng.randrange(10**6)
        texts.append(" ".join(copy))
    every = cut(simhash.fingerprints(docs(spark, texts), "doc_id", "text", 5, 1, True))
    sketches = cut(every.selectExpr("same", "doc_id as rep", "same as root", "keys", "bits"))
    roots = simhash.alike_roots(docs(spark, texts), "doc_id", "text", 5, sketches, 0.8, block=16)
    number = {r.same: r.doc_id for r in every.collect()}
    root = {number[r.u]: number[r.root] for r in roots.collect()}
    mine = {}
    for i in range(160):
        mine.setdefault(root.get(i, i), set()).add(i)
    theirs = {i: {i} for i in range(160)}
    for i in range(160):
        for j in range(i):
            if theirs[i] is not theirs[j] and jaccard(texts[i], texts[j]) >= 0.8:
                theirs[i] |= theirs[j]
                for k in theirs[i]:
                    theirs[k] = theirs[i]
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, {frozenset(x) for x in theirs.values()}))
    assert 20 < len(mine) < 140
