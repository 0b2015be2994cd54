import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillgraph.llm import packing

from .helpers import docs, rows


def check(pieces, size):
    """pieces: (length, sequence, offset): sequences without gap or overlap, within size."""
    by = {}
    for n, s, o in pieces:
        by.setdefault(s, []).append((o, n))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= size
    return len(by)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_plan_uses_each_piece_once(lengths):
    counts = np.bincount(lengths, minlength=25)
    runs = packing.plan(counts, 24)
    used = Counter()
    for ls, n in runs:
        assert sum(ls) <= 24
        for x in ls:
            used[x] += n
    assert used == Counter(lengths)
    places = packing.Places(runs)
    out = [(x, *places.find(x, r)) for x in set(lengths) for r in range(lengths.count(x))]
    n = check(out, 24)
    assert n == sum(r[1] for r in runs) <= 1.25 * -(-sum(lengths) // 24) + 1 or max(lengths, default=0) > 8


def test_plan_finds_exact_complements():
    for ls in ([2047, 1], [1000, 600, 448], [900, 500, 401, 247]):
        counts = np.bincount(ls, minlength=2049) * 1000
        assert packing.plan(counts) == [(tuple(ls), 1000)]


def test_ids_agree_with_tokenizers():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.encoder(*packing.public_files())
    texts = ["", " ", "Hello  world\n\n\tx", "naïve Übergröße ñandú", "it's we'll 123 12", "<|endoftext|> a<|endoftext|>", "a\u00a0b\u2003c", "日本語 🙂🙂", "x" * 3000, "\r\n \r\n", "\x00\x1f", "ǅ Ⅷ ² ½ ٣", "a" + " " * 1_100_000 + "b", ".a" * 400_000, "é" * 700_000]
    import pyarrow.parquet as pq
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    for x in texts:
        assert encode(x) == t.encode(x, add_special_tokens=False).ids, x[:40]


def test_pieces_of():
    assert packing.pieces_of(1) == [(0, 1)] and packing.pieces_of(2048) == [(0, 2048)]
    assert packing.pieces_of(4097) == [(0, 1), (1, 2048), (2049, 2048)] and packing.pieces_of(4096) == [(0, 2048), (2048, 2048)]


def test_table(spark):
    texts = [None, "", "hello world", "hello world", "word " * 5000] + ["some words here"] * 700
    df = docs(spark, texts, extra=True)
    df = df.unionAll(df.filter("doc_id = 2"))
    out = rows(packing.pack_documents(df, *packing.public_files()))
    n = check([(r[3], r[5], r[6]) for r in out], 2048)
    assert n == -(-sum(r[3] for r in out) // 2048) and len(out) == len(texts) + 1 + 2
    encode = packing.encoder(*packing.public_files())
    for d, piece, start, length, crc, _, _ in out:
        ids = np.array([*encode(texts[d] or ""), 0], "<u4")
        assert (start, length) == packing.pieces_of(len(ids))[piece] and crc == zlib.crc32(ids[start : start + length].tobytes())
    assert rows(packing.pack_documents(df.limit(0), *packing.public_files())) == []
