import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph.llm import media

from .helpers import docs, rows


def brute_resize(a, h, w):
    out = np.zeros((h, w, a.shape[2]))
    for y in range(h):
        for x in range(w):
            y0, y1, x0, x1 = y * a.shape[0] / h, (y + 1) * a.shape[0] / h, x * a.shape[1] / w, (x + 1) * a.shape[1] / w
            total = 0
            for i in range(int(y0), min(a.shape[0], int(np.ceil(y1)))):
                for j in range(int(x0), min(a.shape[1], int(np.ceil(x1)))):
                    part = (min(y1, i + 1) - max(y0, i)) * (min(x1, j + 1) - max(x0, j))
                    out[y, x] += part * a[i, j]
                    total += part
            out[y, x] /= total
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 13), st.integers(1, 13), st.integers(1, 7), st.integers(1, 7), st.integers(1, 4))
def test_area_resize(h, w, th, tw, band):
    a = np.random.default_rng(h * 100 + w).integers(0, 256, (h, w, 3))
    assert np.allclose(media.area_resize(a, th, tw, band), brute_resize(a, th, tw))


def test_formats_round_trip():
    rgb = np.random.default_rng(1).integers(0, 256, (5, 7, 3)).astype(np.uint8)
    head = b"# note\n7 5\n255\n"
    for data in (b"P6 " + head + rgb.tobytes(), b"P3\n" + head + b" ".join(b"%d" % v for v in rgb.ravel()), media.encode_bmp(rgb)):
        assert (media.decode(data)[1] == rgb).all()
    assert (media.decode(b"P5 7 5 255\n" + rgb[:, :, 0].tobytes())[1][:, :, 0] == rgb[:, :, 0]).all()
    assert media.decode(b"P1 3 1 1 0 1")[1].ravel().tolist() == [0, 1, 0] == media.decode(b"P4 3 1\n\xa0")[1].ravel().tolist()
    assert media.decode(b"P5 1 1 65535\n\x01\x02")[1].ravel().tolist() == [258]
    assert (media.from_npy(media.to_npy(rgb)) == rgb).all()


def test_tiles_and_bad_media(spark):
    rgb = np.random.default_rng(1).integers(0, 256, (50, 70, 3)).astype(np.uint8)
    data = [(0, bytearray(media.encode_bmp(rgb))), (1, None), (2, bytearray(b"")), (3, bytearray(b"P5 9 9 255\nxx")), (4, bytearray(b"GIF89a")), (5, bytearray(media.encode_bmp(rgb)))]
    df = spark.createDataFrame(data, "id long, pic binary").withColumn("npy", F.lit(1))
    out = media.media_tiles(df, "id", "pic", tile=(32, 32)).collect()
    back = np.zeros_like(rgb)
    for r in out:
        if r.id == 0:
            t = media.from_npy(bytes(r.npy))
            back[r.tile_row * 32 : r.tile_row * 32 + t.shape[0], r.tile_col * 32 : r.tile_col * 32 + t.shape[1]] = t
    assert (back == rgb).all() and {r.id for r in out if r.error} == {1, 2, 3, 4}
    assert len({r.dhash for r in out if r.id in (0, 5)}) == 1
    small = media.media_tiles(df, "id", "pic", size=(8, 9)).filter("id = 0").first()
    assert np.abs(media.from_npy(bytes(small.npy)) - brute_resize(rgb, 8, 9)).max() < 0.51
    assert rows(media.media_tiles(df.limit(0), "id", "pic")) == []


def test_query_is_an_exact_round_trip(spark, tmp_path):
    texts = ["", None, "a" * 64, "é" * 40, "x" * 65, "a" * 64, "long " * 100_000]
    docs(spark, texts, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in media.op6_media_columns(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        pad = raw + bytes(-len(raw) % 64 or 64 * (not raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
        stored = media.to_npy(np.frombuffer(pad, np.uint8).reshape(-1, 64, 1))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert got[2][1:] == got[5][1:]


def test_samples_out_of_range_are_errors(spark):
    bad = [b"P2 1 1 255 300", b"P2 1 1 255 -5", b"P2 1 1 255 99999999999999999999999", b"P5 1 1 9 \xff", b"P2 99999999999999999999999999 99999999 255 1", b"BM" + b"\xff" * 60, b"P6", b"P1 1 1 x"]
    rows = media.media_tiles(spark.createDataFrame(list(enumerate(bad)), "id long, m binary"), "id", "m").collect()
    assert len(rows) == len(bad) and all(r.error and r.npy is None for r in rows)
