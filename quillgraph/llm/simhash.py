"""SimHash near-duplicates: segment bit counts, a grid range join under Manhattan distance, exact verification.

The embedding of a fingerprint is the bit count of each of its 32 two-bit segments. The Manhattan distance of two
embeddings is at most the Hamming distance of the fingerprints. The grid's cells are the values of each choice of
g - t out of g disjoint groups of coordinates: a Manhattan distance of at most t leaves at least g - t groups equal, so
that two such embeddings share a cell. Within a cell, points are sorted by their total bit count, which again differs by at
most the Manhattan distance, and a range join over it meets the points within t; of those the Manhattan distance (counts
in unary, so that it is the number of differing bits) is the lower bound that has to be at most t before
the fingerprints themselves decide. g grows with the number of fingerprints, which keeps cells small; every g finds the same links.

Equal fingerprints are one row throughout. A task emits at most a star for each of its linked sets, never all
pairs. Cells above `cell_cap` distinct fingerprints are taken out and their fingerprints linked in another exact way, of cost
linear in their number: two are within t (even) bits exactly if some value lies within t/2 bits of both, so each
emits its ball of that radius and those that meet in a value link to the least there.

Fingerprints find few of the pairs near Jaccard 0.8. Where those count, 512 minimum hashes of the shingles propose pairs
too: texts that agree in all of any of 20 bands of five share a cell, and there two bits of each minimum estimate the
similarity (standard deviation 0.021 at 0.8). A cell emits a forest of its near texts, at most an edge a text. The
best edge of each component is decided on the sets of shingles; what then is still open is compared set by set, in
blocks of its cluster, within tasks.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, cut, fresh, map_rows, partitions_for, release

_ODD = 0x5555555555555555
#: Minimum hashes: their number, the bands and rows of each band that propose pairs, and the multipliers and summands.
_MINIMA, _BANDS, _ROWS = 512, 20, 5
_TIMES, _PLUS = np.random.RandomState(42).randint(0, 1 << 32, (2, _MINIMA, 1), np.uint32)
_TIMES |= np.uint32(1)
#: How far below the similarity asked for an estimate may lie: three standard deviations at 0.8.
_MARGIN = 0.063
#: Stands for a null id where rows of one text choose a representative.
_NO_ID = -(1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mixed(hashes: np.ndarray, nth: int) -> np.ndarray:
    """Other hashes of the same shingles, by the mixing steps of SplitMix64; nth 0 gives the hashes themselves."""
    if nth:
        hashes = hashes + np.uint64(nth * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        hashes = hashes ^ (hashes >> np.uint64(31))
    return hashes


def _hashes(text: str | None, words: int) -> list[np.ndarray]:
    """XXH64 (seed 42) of the word shingles, repeats included, in arrays of bounded size; none without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    h = xxhash.xxh64_intdigest
    starts = [0]
    for p in parts:
        starts.append(starts[-1] + len(p) + 1)
    words = min(words, len(parts))
    n = len(parts) - words + 1
    return [np.array([h(joined[a:b], 42) for a, b in zip(starts[at : min(at + (1 << 16), n)], (x - 1 for x in starts[at + words :]), strict=False)], "<u8") for at in range(0, n, 1 << 16)]


def _prints(chunks: list[np.ndarray], prints: int) -> list[int]:
    n = sum(map(len, chunks))
    over = np.zeros((prints, 64), np.int64)
    for hashes in chunks:
        for nth in range(prints):
            over[nth] += np.unpackbits(_mixed(hashes, nth).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return [int(np.packbits(2 * x > n, bitorder="little").view("<u8")[0]) for x in over]


def _sketch(chunks: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """The keys of the bands of minimum hashes, and two bits of each minimum: first all low ones, then all high ones."""
    if not chunks:
        return [], []
    least = np.full(_MINIMA, -1, np.int64).astype(np.uint32)
    for hashes in chunks:
        short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        for at in range(0, len(short), 512):
            least = np.minimum(least, (_TIMES * short[at : at + 512] + _PLUS).min(axis=1))
    keys = [_signed(xxhash.xxh64_intdigest(least[i * _ROWS : (i + 1) * _ROWS].tobytes(), i)) for i in range(_BANDS)]
    two = (least * np.uint32(0x9E3779B1)) >> np.uint32(30)
    return keys, np.packbits(np.concatenate([two & 1, two >> 1]).astype(np.uint8)).view("<i8").tolist()


def fingerprint_set(text: str | None, words: int = 4, prints: int = 1) -> list[int]:
    """`prints` independent fingerprints of 64 bits, the first of the XXH64 (seed 42) of word shingles, repeats included; all 0 without words."""
    return _prints(_hashes(text, words), prints)


def fingerprint(text: str | None, words: int = 4) -> int:
    return fingerprint_set(text, words)[0]


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = 4, prints: int = 1, sketches: bool = False) -> DataFrame:
    """(doc_id, fp, more, keys, bits, same) for each row; fp has the first fingerprint's bits as a signed long, more those of the others.

    keys and bits are those of the minimum hashes, and empty without `sketches` or without words; same is a hash of the text.
    """

    def rows(incoming):
        for key, text, same in incoming:
            chunks = _hashes(text, words)
            first, *more = map(_signed, _prints(chunks, prints))
            yield key, first, more, *(_sketch(chunks) if sketches else ([], [])), same

    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("more", longs), ("keys", longs), ("bits", longs), ("same", pa.int64())])
    text = col(text_col).cast("string")
    return map_rows(df.select(col(id_col).cast("long"), text, F.xxhash64(text)), rows, schema, "doc_id long, fp long, more array<long>, keys array<long>, bits array<long>, same long", batch=10_000)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The connected sets of pairs (a, b) as (member, least member), without the least itself."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(values))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(values))
    return values[keep], values[root[keep]]


def _star_rows(df: DataFrame, find) -> DataFrame:
    """Runs `find` (columns as arrays -> pairs) on each partition as a whole and emits its stars (u, v)."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            u, v = _stars(*find(*(c.to_numpy() for c in t.columns)))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return df.mapInArrow(run, "u long, v long")


def _unary(fp: np.ndarray) -> np.ndarray:
    """The counts of the 32 segments, each in two bits as 00, 01 or 11: differing bits are the Manhattan distance."""
    odd = np.uint64(_ODD)
    high, low = (fp >> np.uint64(1)) & odd, fp & odd
    return (high | low) | (high & low) << np.uint64(1)


def _within(t: int):
    def find(cell: np.ndarray, key: np.ndarray, fp: np.ndarray):
        fp = fp.astype(np.int64).view(np.uint64)
        total = np.bitwise_count(fp).astype(np.int64)
        order = np.lexsort((total, key, cell))
        cell, key, fp, total = cell[order], key[order], fp[order], total[order]
        counts = _unary(fp)
        size = np.diff(np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (key[1:] != key[:-1]), True]))
        left = np.repeat(np.cumsum(size), size) - np.arange(len(fp)) - 1  # rows after this one in its cell
        at, a, b, step = np.flatnonzero(left), [], [], 0
        while len(at):
            step += 1
            at = at[left[at] >= step]
            at = at[total[at + step] - total[at] <= t]  # totals rise, so that those further on differ by more
            near = at[np.bitwise_count(counts[at] ^ counts[at + step]) <= t]
            near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= t]
            a.append(fp[near])
            b.append(fp[near + step])
        none = np.zeros(0, np.uint64)
        return np.concatenate([none, *a]).view(np.int64), np.concatenate([none, *b]).view(np.int64)

    return find


def _meeting(value: np.ndarray, fp: np.ndarray):
    order = np.lexsort((fp, value))
    value, fp = value[order], fp[order]
    same = np.flatnonzero(value[1:] == value[:-1])
    return fp[same], fp[same + 1]


def _forest(share: float):
    """Of each cell a forest over its roots: (x, y: texts, u, v: their roots, d: minima that differ), the nearest text of a root first.

    In turn each row, the least text first, is compared with those after it that the forest doesn't join to it yet.
    """
    most = int(_MINIMA * 0.75 * (1 - share + _MARGIN))  # minima whose two bits differ; of unlike ones a quarter agree

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        key, same, root = (c.to_numpy() for c in t.columns[:3])
        order = np.lexsort((same, key))
        key, same, root = key[order], same[order], root[order]
        bits = t.column(3).combine_chunks().flatten().to_numpy().reshape(len(t), -1)[order].view(np.uint64)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(key)])
        start = np.repeat(first, size)
        place = np.arange(len(key)) - start
        by_root = np.lexsort((root, start))
        label = np.empty(len(key), np.int64)
        label[by_root] = np.cumsum(np.r_[0, (root[by_root][1:] != root[by_root][:-1]) | (start[by_root][1:] != start[by_root][:-1])])
        joined = np.arange(len(key))
        at, step, half = np.flatnonzero(place), 0, bits.shape[1] // 2
        while len(at):
            pivot = start[at] + step
            apart = label[at] != label[pivot]
            a, p = at[apart], pivot[apart]
            unlike = bits[a] ^ bits[p]
            d = np.bitwise_count(unlike[:, :half] | unlike[:, half:]).sum(axis=1, dtype=np.int64)
            near = d <= most
            if near.any():
                a, p, d = a[near], p[near], d[near]
                best = np.lexsort((d, label[a]))
                best = best[np.flatnonzero(np.r_[True, np.diff(label[a][best]) != 0])]
                a, p, d = a[best], p[best], d[best]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (same[p], same[a], root[p], root[a], d)], names=["x", "y", "u", "v", "d"])
                joined[label[a]] = label[p]
                label[at] = joined[label[at]]
            step += 1
            at = at[place[at] > step]

    return run


def _candidates(sketches: DataFrame, share: float, cell_cap: int) -> DataFrame:
    """(x, y, u, v, d) by _forest, of all cells of sketches(same, root, keys, bits). A cell of more than `cell_cap` texts is
    dealt out as blocks, of which each pair meets in a cell of its own, so that all its pairs are compared."""
    cells = sketches.select(F.explode("keys").alias("key"), "same", "root", "bits")
    tasks = partitions_for(sketches.sparkSession, sketches.count() * _BANDS, 200_000)
    crowded = cut(cells.groupBy("key").count().filter(F.col("count") > cell_cap))
    if not crowded.isEmpty():
        blocks = F.coalesce(F.ceil(F.col("count") / cell_cap).cast("int"), F.lit(1))
        many = cells.join(F.broadcast(crowded), "key", "left").withColumn("mine", F.pmod(F.xxhash64("same"), blocks).cast("int"))
        many = many.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
        cells = many.select(F.when(F.col("count").isNull(), F.col("key")).otherwise(pair).alias("key"), "same", "root", "bits")
    found = cells.repartition(tasks, "key").mapInArrow(_forest(share), "x long, y long, u long, v long, d long")
    return cut(found.groupBy("x", "y", "u", "v").agg(F.min("d").alias("d")))


def _overlaps(share: float):
    """Pairs of roots with two texts of this Jaccard similarity, by the products of the texts' shingle vectors in each group of rows."""

    def find(group: np.ndarray, root: np.ndarray, sets: list[np.ndarray]):
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        order = np.argsort(group, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            size = np.array([len(sets[i]) for i in rows])
            row = np.repeat(np.arange(len(rows)), size)
            _, term, often = np.unique(np.concatenate([sets[i] for i in rows]), return_inverse=True, return_counts=True)
            kept = often[term] > 1
            row, term = row[kept], (np.cumsum(often > 1) - 1)[term[kept]]
            by_term = np.argsort(term, kind="stable")
            row, term = row[by_term], term[by_term]
            shared = np.zeros((len(rows), len(rows)), np.float32)
            for lo in range(0, int(term[-1]) + 1 if len(term) else 0, 4096):
                i, j = np.searchsorted(term, [lo, lo + 4096])
                held = np.zeros((len(rows), 4096), np.float32)
                held[row[i:j], term[i:j] - lo] = 1
                shared += held @ held.T
            enough = shared >= share * (size[:, None] + size[None, :] - shared) - 1e-6
            i, j = np.nonzero(np.triu(enough, 1) & (root[rows][:, None] != root[rows][None, :]))
            u, v = _stars(root[rows][i], root[rows][j])
            a.append(u)
            b.append(v)
        return np.concatenate(a), np.concatenate(b)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            u, v = find(t.column(0).to_numpy(), t.column(1).to_numpy(), [x.values.to_numpy() for x in t.column(2)])
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def alike_roots(df: DataFrame, id_col: str, text_col: str, words: int, sketches: DataFrame, share: float, cell_cap: int = 2048, block: int = 1024) -> DataFrame:
    """(u, root) for each root of sketches that chains of texts of df of Jaccard similarity `share` or more connect to another.

    sketches: (same, rep, root, keys, bits), a row a text, cheap to read again; rep: the id of one row with that text. Every
    root first has its best edge of the forest decided. Roots with an edge left open are then clustered, and the texts
    of each cluster compared: those of its largest root with all others, and the others among themselves, in
    blocks of at most `block` texts of a side.
    """
    spark = df.sparkSession
    text = col(text_col).cast("string")
    every = df.select(F.xxhash64(text).alias("same"), F.coalesce(col(id_col).cast("long"), F.lit(_NO_ID)).alias("rep"), text.alias("text"))
    schema = pa.schema([("same", pa.int64()), ("set", pa.list_(pa.int64()))])

    def sets(incoming):
        for same, _, text in incoming:
            yield same, np.unique(np.concatenate(_hashes(text, words)).view(np.int64)).tolist()

    def sets_of(asked: DataFrame) -> DataFrame:
        # By the representative's id too, so that a text's many copies don't meet in a task.
        return map_rows(every.join(asked.select("same", "rep"), ["same", "rep"]).dropDuplicates(["same"]), sets, schema, "same long, set array<long>", batch=1000)

    def renamed(edges: DataFrame, roots: DataFrame) -> DataFrame:
        for c in ("u", "v"):
            edges = edges.join(roots.select(F.col("u").alias(c), F.col("root").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        return edges.filter("u <> v")

    forest = _candidates(sketches, share, cell_cap)
    ends = forest.select(F.explode(F.array("u", "v")).alias("root"), F.struct("d", "x", "y", "u", "v").alias("e"))
    best = cut(ends.groupBy("root").agg(F.min("e").alias("e")).select("e.*").distinct())
    held = cut(sets_of(sketches.join(best.select(F.explode(F.array("x", "y")).alias("same")).distinct(), "same", "left_semi")))
    both = best.join(held.select(F.col("same").alias("x"), F.col("set").alias("a")), "x").join(held.select(F.col("same").alias("y"), F.col("set").alias("b")), "y")
    shared = F.size(F.array_intersect("a", "b"))
    roots = cut(connected(both.filter(shared >= share * (F.size("a") + F.size("b") - shared) - 1e-9).select("u", "v")))
    touched = cut(renamed(forest, roots).select(F.explode(F.array("u", "v")).alias("root")).distinct())
    release(spark)
    if touched.isEmpty():
        return roots
    now = sketches.join(roots.select(F.col("u").alias("root"), F.col("root").alias("_to")), "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")
    now = cut(now.join(touched, "root", "left_semi").select("same", "rep", "root", "keys", "bits"))
    clusters = cut(connected(_candidates(now, share, cell_cap).select("u", "v")).select(F.col("u").alias("root"), F.col("root").alias("cluster")))
    members = now.join(clusters, "root").select("same", "rep", "root", "cluster")
    members = cut(members.join(sets_of(members), "same").select("root", "cluster", "same", "set"))
    sizes = members.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum(F.size("set")).alias("terms"))
    main = sizes.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    is_main = F.col("root") == F.col("main")
    blocks = lambda c: F.greatest(F.ceil(F.sum(F.when(c, F.col("n"))) / block), F.ceil(F.sum(F.when(c, F.col("terms"))) / (256 * block))).cast("int")
    dealt = cut(sizes.join(main, "cluster").groupBy("cluster", "main").agg(blocks(is_main).alias("mains"), blocks(~is_main).alias("others"), F.sum("n").alias("n")))
    rows = _with_hot(members, dealt, "cluster", members.count())
    in_main = F.col("root") == F.col("main")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("same"), F.when(in_main, F.col("mains")).otherwise(F.col("others"))).cast("int") + F.when(in_main, 0).otherwise(F.col("mains")))
    meets = F.when(in_main, F.sequence("mains", F.col("mains") + F.col("others") - 1)).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("mains") + F.col("others") - 1), F.col("mine")))
    rows = rows.select("cluster", "root", "set", "mine", F.explode(meets).alias("other"))
    rows = rows.select(F.xxhash64("cluster", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "root", "set")
    late = rows.repartition("group").mapInArrow(_overlaps(share), "u long, v long")
    return connected(roots.withColumnRenamed("root", "v").unionAll(late))


def near_links(distinct: DataFrame, t: int = 4, cell_cap: int = 2048, groups: int | None = None) -> DataFrame:
    """Edges (u, v) that connect just the fingerprints which chains of at most t differing bits connect.

    distinct: a column fp without repeats, cheap to read again; with a column nth, only those of equal nth meet. t even, 2 to 8.
    """
    if t % 2 or not 2 <= t <= 8:
        raise ValueError("t must be 2, 4, 6 or 8")
    spark = distinct.sparkSession
    if "nth" not in distinct.columns:
        distinct = distinct.withColumn("nth", F.lit(0))
    kinds = [r[0] for r in distinct.groupBy("nth").count().select("count").collect()]
    n = sum(kinds)
    g = groups or t + 2 + sum(max(kinds, default=0) > 1 << e for e in (20, 25, 30))
    parts = [sum(3 << 2 * int(i) for i in seg) for seg in np.array_split(np.arange(32), g)]
    masks = [_signed(sum(parts[i] for i in chosen)) for chosen in combinations(range(g), g - t)]
    odd = F.lit(_signed(_ODD))
    even_bit, odd_bit = F.col("fp").bitwiseAND(odd), F.shiftrightunsigned("fp", 1).bitwiseAND(odd)
    counts = even_bit.bitwiseXOR(odd_bit).bitwiseOR(F.shiftleft(even_bit.bitwiseAND(odd_bit), 1))  # 32 sums of two bits
    cells = distinct.select("fp", "nth", counts.alias("c")).select(F.posexplode(F.array(*(F.col("c").bitwiseAND(F.lit(m)) for m in masks))).alias("cell", "key"), "fp", "nth")
    cells = cells.select((F.col("nth") * len(masks) + F.col("cell")).cast("int").alias("cell"), "key", "fp", "nth")
    tasks = partitions_for(spark, n * len(masks))
    crowded = cut(cells.groupBy("cell", "key").count().filter(F.col("count") > cell_cap).select("cell", "key"))
    if crowded.isEmpty():
        return _star_rows(cells.select("cell", "key", "fp").repartition(tasks, "cell", "key"), _within(t))
    few = cells.join(crowded, ["cell", "key"], "left_anti").select("cell", "key", "fp")
    many = cells.join(crowded, ["cell", "key"], "left_semi").select("fp", "nth").distinct()
    flips = [0, *(_signed(sum(1 << b for b in bits)) for r in range(1, t // 2 + 1) for bits in combinations(range(64), r))]
    balls = many.select(F.explode(F.transform(F.array(*map(F.lit, flips)), lambda m: m.bitwiseXOR(F.col("fp")))).alias("value"), "fp", "nth")
    balls = balls.select(F.col("value").bitwiseXOR(F.when(F.col("nth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64("nth"))).alias("value"), "fp")  # other nth, other values
    return _star_rows(few.repartition(tasks, "cell", "key"), _within(t)).unionAll(_star_rows(balls.repartition(tasks, "value"), _meeting))


def _with_hot(big: DataFrame, small: DataFrame, key: str, total: int) -> DataFrame:
    """big join small(key, n, ...) on key. n: rows of big with the key, of `total`.

    The keys with over a 1000th of all rows, fewer than 1000, are broadcast, so that their rows stay where they are.
    """
    share = total / 1000
    others = [c for c in small.columns if c not in (key, "n")]
    hot = small.filter(F.col("n") > share).select(key, F.struct(*others).alias("_known"))
    met = big.join(F.broadcast(hot), key, "left")
    cold = met.filter("_known is null").drop("_known").join(small.filter(F.col("n") <= share).drop("n"), key)
    return met.filter("_known is not null").select(*big.columns, *(F.col(f"_known.{c}") for c in others)).unionAll(cold.select(*big.columns, *others))


def _pairs(find):
    """mapInArrow of `find` (two columns of longs of a whole partition -> two columns) to distinct rows (u, v)."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            u, v = find(t.column(0).to_numpy(), t.column(1).to_numpy())
            order = np.lexsort((v, u))
            u, v = u[order], v[order]
            new = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])][: len(u)])
            yield pa.RecordBatch.from_arrays([pa.array(u[new]), pa.array(v[new])], names=["u", "v"])

    return run


def _least_of(key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted rows, and for each the least of the others of its key."""
    order = np.lexsort((other, key))
    key, other = key[order], other[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key, other, np.repeat(other[first], np.diff(np.r_[first, len(key)]))


def _large_star(key: np.ndarray, other: np.ndarray):
    key, other, least = _least_of(key, other)
    after = other > key
    return other[after], np.minimum(key, least)[after]


def _small_star(key: np.ndarray, other: np.ndarray):
    key, other, least = _least_of(key, other)
    rest = other > least
    return np.r_[key, other[rest]], np.r_[least, least[rest]]


def connected(edges: DataFrame, max_rounds: int = 50, salts: int = 64, per_task: int = 1_000_000) -> DataFrame:
    """(u, root) for each vertex of the edges: root is the least vertex of its component.

    Each task first replaces its edges by stars; what then fits in a task of `per_task` edges is settled there. More edges go
    through alternating large-star and small-star rounds (Kiveris et al., 2014), each written to the shared folder. A
    vertex to which over a 200th of all edges point, of which there are fewer than 200, has its larger neighbours dealt
    out to `salts` tasks, each of which knows its smaller ones.
    """
    spark = edges.sparkSession
    stars = lambda e: e.mapInArrow(_pairs(_stars), "u long, v long")
    roots = lambda e: e.select("u", F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
    now = cut(stars(edges.filter("u <> v")))
    if now.count() <= per_task:
        return roots(cut(stars(now.coalesce(1))))
    before = None
    for _ in range(max_rounds):
        hubs = now.groupBy("v").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        after = hubs.agg(F.sum("n"), F.sum("h"), F.max("n")).first()
        if after == before or not after[0]:
            break
        before = after
        bound = max(after[0] / 200, 1000)
        hot = [r.v for r in hubs.filter(F.col("n") > bound).select("v").collect()] if after[2] > bound else []
        tasks = partitions_for(spark, 2 * after[0])
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("key"), F.col("v").alias("other")), F.struct(F.col("v").alias("key"), F.col("u").alias("other")))).alias("e")).select("e.*")
        dealt = F.when(~F.col("key").isin(hot), F.array(F.lit(0))).when(F.col("other") > F.col("key"), F.array(F.pmod(F.xxhash64("other"), F.lit(salts)).cast("int"))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))
        ends = ends.withColumn("salt", F.explode(dealt)) if hot else ends.withColumn("salt", F.lit(0))
        large = ends.repartition(tasks, "key", "salt").select("key", "other").mapInArrow(_pairs(_large_star), "u long, v long")
        now = cut(large.repartition(tasks, "u").mapInArrow(_pairs(_small_star), "u long, v long"))
        release(spark)
    else:
        raise RuntimeError("components did not settle")
    return roots(now)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, t: int = 4, cell_cap: int = 2048, prints: int = 1, share: float | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for each row of df: component_id is the least doc_id within chains of t bits.

    Null, empty and blank texts have fingerprint 0 and link like any other. Rows with a null id count, but name no
    component: component_id is null where a component has no other. Repeated rows stay repeated; other columns are ignored.

    prints: independent fingerprints of each text; texts link where any of them are within t bits. Where one alone finds a
    link with probability p, so many find it with 1 - (1 - p)^prints, while texts further apart stay as good as unlinked.

    share: texts also link from this Jaccard similarity of their sets of shingles on. Minimum hashes propose the pairs, 99.8 %
    of those just at 0.8 and nearly all above; the sets themselves decide.
    """
    every = cut(fingerprints(df, id_col, text_col, words, prints, share is not None))
    distinct = cut(every.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    if prints == 1:
        links = near_links(distinct.select("fp"), t, cell_cap)
    else:
        # The graph's vertices are fingerprints; those of one text are joined to its first.
        pairs = cut(every.select("fp", F.posexplode("more").alias("nth", "other")).distinct())
        values = cut(distinct.select(F.lit(0).alias("nth"), "fp").unionAll(pairs.select(F.col("nth") + 1, F.col("other").alias("fp")).distinct()))
        links = near_links(values, t, cell_cap).unionAll(pairs.select("fp", "other"))
    roots = cut(connected(links))
    release(df.sparkSession)
    linked = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
    if share is not None:
        texts = every.filter(F.size("keys") > 0).groupBy("same").agg(F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("rep"), *(F.first(c).alias(c) for c in ("fp", "keys", "bits")))
        sketches = cut(texts.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select("same", "rep", F.coalesce("root", "fp").alias("root"), "keys", "bits"))
        alike = cut(alike_roots(df, id_col, text_col, words, sketches, share, cell_cap))
        release(df.sparkSession)
        linked = linked.withColumn("_u", F.coalesce("root", "fp")).join(alike.select(F.col("u").alias("_u"), F.col("root").alias("_to")), "_u", "left").withColumn("root", F.coalesce("_to", "root"))
    linked = cut(linked.filter("root IS NOT NULL").select("fp", "root", "least"))
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    moved = _with_hot(linked.select("root", "fp"), named, "root", linked.count()).select("fp", "component_id")
    names = cut(distinct.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), "n"))
    total = names.agg(F.sum("n")).first()[0] or 0
    return _with_hot(every.select("doc_id", "fp"), names, "fp", total).select("doc_id", "fp", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """df with one row of each component: that with the least id; rows with a null id all stay.

    Of rows that repeat this id the least by its columns stays. All columns stay.
    """
    key = fresh(df, "_id")
    marks = near_duplicates(df, id_col, text_col, **options).filter(F.col("doc_id").isNotNull())
    ids = cut(marks.groupBy(F.col("doc_id").alias("_id")).agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("first"), F.count("*").alias("n")).filter("not first or n > 1"))
    same = col(id_col).cast("long") == F.col(key)
    kept = df.join(ids.filter("not first").select(F.col("_id").alias(key)), same, "left_anti")
    again = ids.filter("first").select(F.col("_id").alias(key))
    if again.isEmpty():
        return kept
    nth = fresh(df, "_nth")
    least = W.partitionBy(col(id_col).cast("long")).orderBy(*(F.to_json(F.struct(col(c))) for c in df.columns))
    one = kept.join(again, same, "left_semi").withColumn(nth, F.row_number().over(least)).filter(F.col(nth) == 1).drop(nth)
    return kept.join(again, same, "left_anti").unionAll(one)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    from ._common import read

    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
