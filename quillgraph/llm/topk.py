"""Exact top-k inner products by vector-approximation files.

The approximation of a vector is a byte for each component: its cell in a grid of the table's range. Codes are a
column of a table of their own columns, and the first pass reads them alone: it bounds every score from below and above, and keeps
for each query what can still be among its k best. A second pass reads exact vectors of those alone, in two waves
by falling upper bound: the first k of a query, and then the others whose bound reaches the kth exact score.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, cut, read

CELLS = 256
#: Highest score that a long holds; beyond 38 digits a decimal holds none.
_LONG, _WIDE = (1 << 63) - 1, 10**38 - 1


def finite(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x array<double>) of the rows with an id and a vector of finite components."""
    x = F.transform(col(vector_col), lambda c: c.cast("double"))
    fine = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    return df.filter(fine & col(id_col).isNotNull()).select(col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as doubles; products beyond a double's range count as the largest double."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -most, most)


@dataclass(frozen=True)
class Cells:
    """Even cells from `low` to `high`; the outer ones reach to the table's least and greatest integer."""

    least: float
    low: float
    high: float
    greatest: float

    @property
    def width(self) -> float:
        return max(1.0, math.ceil((self.high - self.low + 1) / CELLS))

    def codes(self, v: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip(np.floor((v - self.low) / self.width), 0, CELLS - 1).astype(np.uint8)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest integer of each cell."""
        first = self.low + self.width * np.arange(CELLS)
        last = first + self.width - 1
        first[0], last[-1] = min(first[0], self.least), max(last[-1], self.greatest)
        return first, last


def bounds(queries: np.ndarray, codes: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of each query's score with each code row, widened by what rounding may take."""
    first, last = cells.edges()
    with np.errstate(all="ignore"):
        middle, half = ((first + last) / 2)[codes], ((last - first) / 2)[codes]
        about, reach = queries @ middle.T, np.abs(queries) @ half.T
        exact = np.abs(queries).max(initial=0) * max(abs(first[0]), abs(last[-1])) * queries.shape[1] < 1 << 50
        slack = 0.0 if exact else 1e-9 * (np.abs(queries) @ np.abs(middle).T + reach)
        low, high = about - reach - slack, about + reach + slack
    return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


def _scan(ids: np.ndarray, queries: np.ndarray, cells: Cells, k: int, rows_at_once: int = 4096, at_once: int = 256):
    """Of a partition's codes those that can be among the k best: (query_id, vec_id, low, high)."""

    def run(batches):
        best = np.full((len(ids), k), -np.inf)  # the k greatest lower bounds
        held: list[list[tuple]] = [[] for _ in range(0, len(ids), at_once)]
        for b in batches:
            vec, raw = b.column(0).to_numpy(), b.column(1)
            codes = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(vec), -1)
            for lo in range(0, len(vec), rows_at_once):
                v, c = vec[lo : lo + rows_at_once], codes[lo : lo + rows_at_once]
                for part, q in enumerate(range(0, len(ids), at_once)):
                    low, high = bounds(queries[q : q + at_once], c, cells)
                    low[ids[q : q + at_once, None] == v[None, :]] = -np.inf
                    high[ids[q : q + at_once, None] == v[None, :]] = -np.inf
                    top = np.concatenate([best[q : q + at_once], low], axis=1)
                    best[q : q + at_once] = np.partition(top, top.shape[1] - k, axis=1)[:, -k:]
                    at, which = np.nonzero((high >= best[q : q + at_once].min(axis=1)[:, None]) & (high > -np.inf))
                    held[part].append((at, v[which], low[at, which], high[at, which]))
                    if sum(len(x[0]) for x in held[part]) > 1_000_000:
                        held[part] = [_still(held[part], best[q : q + at_once].min(axis=1))]
        for part, q in enumerate(range(0, len(ids), at_once)):
            if held[part]:
                at, v, low, high = _still(held[part], best[q : q + at_once].min(axis=1))
                for lo in range(0, len(at), 100_000):
                    s = slice(lo, lo + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[q + at[s]]), pa.array(v[s]), pa.array(low[s]), pa.array(high[s])], names=["query_id", "vec_id", "low", "high"])

    return run


def _still(parts: list[tuple], need: np.ndarray) -> tuple:
    at, v, low, high = (np.concatenate(c) for c in zip(*parts, strict=True))
    keep = high >= need[at]
    return at[keep], v[keep], low[keep], high[keep]


def _exact(scale: float):
    """Rows (query_id, vec_id, q, x) to (query_id, vec_id, score decimal(38,0)); scores of more digits count as the widest."""

    def run(batches):
        for b in batches:
            sizes, scores = b.column(2).value_lengths().to_numpy(), [0] * b.num_rows
            for d in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == d)
                q, x = (whole(b.column(i).take(pa.array(rows)).flatten().to_numpy(), scale).reshape(len(rows), d) for i in (2, 3))
                with np.errstate(over="ignore"):
                    plain = np.abs(q).max(axis=1) * np.abs(x).max(axis=1) * d < 1 << 53
                product = np.einsum("ij,ij->i", q, np.where(plain[:, None], x, 0))
                for i, row in enumerate(rows.tolist()):
                    scores[row] = int(product[i]) if plain[i] else max(-_WIDE, min(_WIDE, sum(int(a) * int(c) for a, c in zip(q[i], x[i], strict=True))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(Decimal, scores), pa.decimal128(38, 0))], names=["query_id", "vec_id", "score"])

    return run


def _ranked(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)


def _few_equal(vectors: DataFrame, k: int, broadcast_most: int = 100_000) -> DataFrame:
    """vectors(vec_id, d, x) without those that can't be among the k best because too many equal ones go before them.

    Equal vectors score alike and smaller ids go first, so that k + 1 ids of each suffice (one may be the query's), and k rows of an id.
    Only vectors whose hash more than k rows have are compared whole; the others are neither shuffled nor sorted.
    """
    hashed = vectors.withColumn("_h", F.xxhash64("x"))
    often = cut(hashed.groupBy("_h").agg(F.count("*").alias("_n")).filter(F.col("_n") > k).select("_h"))
    often = F.broadcast(often) if often.count() <= broadcast_most else often
    same, row = W.partitionBy("x").orderBy("vec_id"), W.partitionBy("x", "vec_id").orderBy(F.lit(1))
    many = hashed.join(often, "_h", "left_semi").drop("_h")
    many = many.withColumn("_r", F.dense_rank().over(same)).filter(F.col("_r") <= k + 1).withColumn("_n", F.row_number().over(row)).filter(F.col("_n") <= k)
    return hashed.join(often, "_h", "left_anti").drop("_h").unionByName(many.select(*vectors.columns))


def top_k(df: DataFrame, id_col: str, vector_col: str, every: int = 20, k: int = 20, scale: float = 64.0, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row whose id is divisible by `every`, the k highest integer inner products.

    Ties go to the smaller vec_id; queries with fewer than k other vectors get all. Vectors that are null or hold a null or
    a non-finite component take no part, and vectors meet only those of their own length. A query meets no row of its own
    id; of rows that repeat a query's id, the least vector asks. Repeated candidates count as often as they are there.
    Scores are exact and ranked exactly, up to 38 digits; those beyond a long's range are given as its ends. An empty table
    gives no row. Each block of queries is one job that reads all codes, so what is sent to tasks doesn't grow with the
    data; exact vectors are read once for all blocks.
    """
    spark = df.sparkSession
    # d tells lengths apart; vectors of none score as [0] does.
    vectors = finite(df, id_col, vector_col).select("vec_id", F.size("x").alias("d"), F.when(F.size("x") > 0, F.col("x")).otherwise(F.array(F.lit(0.0))).alias("x"))
    asked = cut(vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("x", "d")).alias("v")).select("vec_id", "v.x", "v.d"))
    kept = _few_equal(vectors, k)
    stats = vectors.groupBy("d").agg(F.min(F.array_min("x")).alias("lo"), F.max(F.array_max("x")).alias("hi"), F.avg(F.expr("aggregate(x, 0D, (a, c) -> a + c) / size(x)")).alias("m"), F.avg(F.expr("aggregate(x, 0D, (a, c) -> a + c * c) / size(x)")).alias("s")).collect()
    cells = {}
    for r in stats:
        least, greatest = whole(np.array([r.lo, r.hi]), scale).tolist()
        spread = 4 * math.sqrt(max(r.s - r.m * r.m, 0.0)) if math.isfinite(r.s) else 0.0
        low, high = whole(np.array([r.m - spread, r.m + spread]), scale).tolist()
        cells[r.d] = Cells(least, min(max(low, least), greatest), max(min(high, greatest), least), greatest)

    def coded(batches):
        for b in batches:
            codes = [cells[d].codes(whole(x.values.to_numpy(), scale)).tobytes() for d, x in zip(b.column(2).to_pylist(), b.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(codes, pa.binary())], names=["vec_id", "x", "d", "code"])

    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/top-k-{uuid.uuid4()}"
    kept.select("vec_id", "x", "d").mapInArrow(coded, "vec_id long, x array<double>, d int, code binary").write.parquet(folder)
    table = spark.read.parquet(folder)
    blocks = max(1, -(-asked.count() // block))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    found, ddl = [], "query_id long, vec_id long, low double, high double"
    for b in range(blocks):
        rows = sorted(((r.d, r.vec_id, r.x) for r in numbered.filter(F.col("block") == b).collect()), key=lambda r: r[:2])
        for d in sorted({r[0] for r in rows}):
            mine = [r for r in rows if r[0] == d]
            scan = _scan(np.array([r[1] for r in mine]), whole(np.array([r[2] for r in mine], np.float64), scale), cells[d], k)
            found.append(cut(table.filter(F.col("d") == d).select("vec_id", "code").mapInArrow(scan, ddl)))
    near = spark.createDataFrame([], ddl)
    for f in found:
        near = near.unionAll(f)
    # What another task's lower bounds rule out goes; equal rows of a repeated id stay one here and meet its rows again below.
    need = _ranked(near, k, F.desc("low")).filter(F.col("rank") == k).select("query_id", F.col("low").alias("need"))
    near = near.join(need, "query_id", "left").filter(F.col("high") >= F.coalesce("need", F.lit(float("-inf")))).groupBy("query_id", "vec_id").agg(F.max("high").alias("high"))
    near = cut(near.withColumn("nth", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("high"), "vec_id"))))

    def scored(pairs: DataFrame) -> DataFrame:
        at = asked.select(F.col("vec_id").alias("query_id"), F.col("x").alias("q"), "d")
        both = pairs.join(table.select("vec_id", "x", "d"), "vec_id").join(at, ["query_id", "d"])
        return both.select("query_id", "vec_id", "q", "x").mapInArrow(_exact(scale), "query_id long, vec_id long, score decimal(38,0)")

    order = (F.desc("score"), F.asc("vec_id"))
    first = cut(scored(near.filter(F.col("nth") <= k).select("query_id", "vec_id")))
    kth = _ranked(first, k, *order).filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
    # A double may round the score up by 2^-53 of it.
    rest = near.filter(F.col("nth") > k).join(kth, "query_id", "left").filter(F.col("high") >= F.coalesce(F.col("kth") - F.abs("kth") * 1e-15, F.lit(float("-inf")))).select("query_id", "vec_id")
    every_one = first.unionAll(scored(rest))
    out = cut(_ranked(every_one, k, *order).select("query_id", "rank", "vec_id", F.greatest(F.least("score", F.lit(_LONG)), F.lit(-_LONG - 1)).cast("long").alias("score")))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out


def op9_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
