import random
import zlib
from collections import Counter

import numpy as np

from quillgraph.llm import language

from .helpers import rows

DDL = "doc_id long, text string, lang string, lang_pred string"


def brute_grams(text):
    s, out = "".join(c if c.isalpha() else " " for c in text.lower()), Counter()
    s = " " + " ".join(s.split()) + " "
    if s.strip():
        for n in (1, 2, 3):
            out.update(s[i : i + n] for i in range(len(s) - n + 1))
        del out[" "]
    return out


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def brute_rank(counts, top):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:top]]


def corpus(n, seed=0):
    draw = random.Random(seed)
    parts = {"aa": "lo ri ma te shu", "bb": "gra chi tön eß wo", "cc": "жи ла по ст"}
    out = []
    for i in range(n):
        lang = draw.choice(sorted(parts))
        out.append((i, " ".join("".join(draw.choices(parts[lang].split(), k=draw.randint(1, 4))) for _ in range(draw.randint(3, 60))) + ".", lang, None))
    return out


def test_grams_agree_with_slices():
    draw = random.Random(1)
    for text in ["", "...", "a", "Ab c", "ǅ İ x", "\x00\ud800 z".replace("\ud800", ""), *("".join(draw.choice("abÄß 1.\n漢😀") for _ in range(50)) for _ in range(50))]:
        values, n = language.grams(text)
        assert dict(zip(values.tolist(), n.tolist())) == {code(g): c for g, c in brute_grams(text).items()}


def test_pieces_of_long_texts_count_as_one(monkeypatch):
    text = "".join(random.Random(2).choice("abc d") for _ in range(1000))
    whole = language.grams(text)
    monkeypatch.setattr(language, "_CHUNK", 7)
    assert all(np.array_equal(a, b) for a, b in zip(language.grams(text), whole))


def test_profiles_distances_and_predictions_agree_with_brute_force(spark):
    data = corpus(150) + [(200, None, "aa", None), (201, "123 ...", "aa", None), (202, "lo lo", None, None), (203, "", "bb", None)]
    df = spark.createDataFrame(data, DDL).repartition(3)
    made = language.learn_profiles(df, "text", "lang", top=40, held=200, salts=3)
    want = {}
    for _, text, lang, _ in data:
        if text is not None and lang is not None:
            want.setdefault(lang, Counter()).update(brute_grams(text))
    profiles = {k: brute_rank(v, 40) for k, v in want.items()}
    assert made.profiles == {k: [code(g) for g in v] for k, v in profiles.items()}
    got = {r[0]: r[1:] for r in rows(language.identify(df, made, "doc_id", "text"))}
    for i, text, _, _ in data:
        own = brute_rank(brute_grams(text or ""), 40)
        if not own:
            assert got[i] == ("und", 0.0)
            continue
        far = {k: sum(abs(p.index(g) - r) if g in p else 40 for r, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert got[i] == (best, round(1 - far[best] / (40 * len(own)), 6))


def test_held_out_accuracy_and_folds(spark, tmp_path):
    data = corpus(400, 3)
    spark.createDataFrame([(i, t, lang, len(t)) for i, t, lang, _ in data] + [(None, "lo ri lo", "zz", 1), (999, "long lori mate " * 200_000, None, 1)], "doc_id long, text string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = language.op13_language_id(spark, str(tmp_path)).collect()
    assert len(out) == 402
    held = {r.doc_id: r for r in out}
    assert all(held[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in data)
    assert held[None].held_out and held[None].lang_pred == "aa" and held[999].lang_pred == "aa"
    assert all(held[i].lang_pred == lang for i, _, lang, _ in data) and all(0 <= r.score <= 1 for r in out)


def test_empty_tables_nothing_learnt_and_repeated_rows(spark):
    df = spark.createDataFrame(corpus(10), DDL)
    none = language.learn_profiles(df.limit(0), "text", "lang")
    assert none.profiles == {} and {r[1:] for r in rows(language.identify(df, none, "doc_id", "text"))} == {("und", 0.0)}
    made = language.learn_profiles(df.unionAll(df), "text", "lang")
    assert made.profiles == language.learn_profiles(df, "text", "lang").profiles
    assert len(rows(language.identify(df.unionAll(df), made, "doc_id", "text"))) == 20 and rows(language.identify(df.limit(0), made, "doc_id", "text")) == []
