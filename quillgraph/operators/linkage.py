"""Record linkage: exact on a number, then the closest title."""

from __future__ import annotations

import difflib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgraph.functions.text import normalize_title, number_after, part_number, word_count
from quillgraph.sources.tables import cut

#: What containment scores, and from which length on.
CONTAINED, LEAST_CONTAINED = 0.95, 5


def score_titles(title: str, other: str) -> float:
    """The ratio of matching blocks, or the fixed score where one holds the other."""
    if min(len(title), len(other)) >= LEAST_CONTAINED and (other in title or title in other):
        return CONTAINED
    return difflib.SequenceMatcher(None, title, other).ratio()


class Titles:
    """Titles as rows of character counts and as bits by character, so that a title meets many others in one array operation.

    The ratio of matching blocks is difflib's, block by block: a block's length, and of equal ones the first, come from runs of bits. Titles of 200 characters
    and more go through difflib itself, whose rule for frequent characters begins there.
    """

    LONG = 200

    def __init__(self, titles: list[str], parts: list[int | None], ids: list[int]):
        self.titles, self.ids = titles, np.array(ids, np.int64)
        self.parts = np.array([np.nan if p is None or p != p else p for p in parts], float)
        self.place = {c: i for i, c in enumerate(sorted(set("".join(titles))))}
        self.lengths = np.array([len(t) for t in titles], np.int64)
        which, where = np.repeat(np.arange(len(titles)), self.lengths), np.concatenate([np.arange(n) for n in self.lengths] or [[]]).astype(np.int64)
        chars = np.array([self.place[c] for t in titles for c in t], np.int64)
        self.counts = np.bincount(which * len(self.place) + chars, minlength=len(titles) * len(self.place)).reshape(len(titles), len(self.place)).astype(np.int32)
        self.words = np.maximum(1, -(-self.lengths // 64))
        self.bits: dict[int, list[np.ndarray]] = {}  # by number of words: for each word, character and title the places that hold it
        self.row = np.zeros(len(titles), np.int64)
        for w in np.unique(self.words[self.lengths < self.LONG]).tolist():
            of = np.flatnonzero((self.words == w) & (self.lengths < self.LONG))
            self.row[of] = np.arange(len(of))
            mine = np.isin(which, of)
            bits = np.zeros((w, len(self.place) + 1, len(of)), np.uint64)
            np.add.at(bits, (where[mine] // 64, chars[mine], self.row[which[mine]]), np.uint64(1) << (where[mine] % 64).astype(np.uint64))
            self.bits[w] = list(bits)
        self.known: dict[int, difflib.SequenceMatcher] = {}  # each long title is indexed once
        self.scored = 0

    def count(self, title: str) -> np.ndarray:
        return np.bincount([self.place[c] for c in title if c in self.place], minlength=len(self.place))

    def _longest(self, chars: np.ndarray, words: list[np.ndarray], at: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray):
        """Begin in both and length of the longest block that a title's places a to b share with c to d of the others in rows `at`.

        Bit j of a place's words says whether a run of so many characters ends there and at the other's place j. An empty place ends each part.
        """
        spans = b - a + 1
        starts = np.cumsum(spans) - spans
        ends = starts + spans - 1
        of_char = chars[np.arange(spans.sum()) - np.repeat(starts - a, spans)] * words[0].shape[1] + np.repeat(at, spans)
        below = lambda n: np.where(n >= 64, ~np.uint64(0), (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1))
        here = [bits.ravel()[of_char] for bits in words]
        for w, bits in enumerate(here):
            bits &= np.repeat(below(np.clip(d - 64 * w, 0, 64)) & ~below(np.clip(c - 64 * w, 0, 64)), spans)
            bits[ends] = 0
        size, end, last, open_ = np.zeros_like(a), np.zeros_like(a), np.zeros_like(a), np.arange(len(a))
        one, held, k = np.uint64(1), np.flatnonzero(reduce(np.bitwise_or, here)), 1
        run = [r[held] for r in here]
        while len(held):
            new = np.searchsorted(held, starts[open_])
            has = held[np.minimum(new, len(held) - 1)]
            has = (has >= starts[open_]) & (has < ends[open_])
            open_, new = open_[has], new[has]
            size[open_], end[open_] = k, held[new] - starts[open_] + a[open_]
            for w in reversed(range(len(run))):
                r = run[w][new]
                last[open_] = np.where(r != 0, 64 * w + np.frexp((r & (~r + one)).astype(float))[1] - 1, last[open_])
            held, k = held + 1, k + 1
            longer = [(r << one) & bits[held] for r, bits in zip(run, here, strict=True)]
            for w in range(1, len(run)):
                longer[w] |= (run[w - 1] >> np.uint64(63)) & here[w][held]
            on = np.flatnonzero(reduce(np.bitwise_or, longer))
            run, held = [r[on] for r in longer], held[on]
        return end - size + 1, last - size + 1, size

    def ratios(self, title: str, of: np.ndarray, least: float) -> np.ndarray:
        """The ratios of matching blocks with the titles `of`, or -1 where it is certain that it is below `least`.

        Blocks are found longest first, for all of them at once; what is left and right of one can match at most the shorter of both sides there.
        """
        out = np.full(len(of), -1.0)
        n, chars = len(title), np.array([*(self.place.get(c, len(self.place)) for c in title), len(self.place)], np.int64)
        for i in np.flatnonzero(self.lengths[of] >= self.LONG).tolist():
            matcher = self.known.setdefault(int(of[i]), difflib.SequenceMatcher(None, "", self.titles[of[i]]))
            matcher.set_seq1(title)
            out[i] = matcher.ratio()
        for w, words in self.bits.items():
            mine = np.flatnonzero((self.words[of] == w) & (self.lengths[of] < self.LONG))
            rows, total = self.row[of[mine]], self.lengths[of[mine]] + n
            matched, which = np.zeros(len(mine), np.int64), np.arange(len(mine))
            a, b, c, d = np.zeros_like(which), np.full_like(which, n), np.zeros_like(which), total - n
            alive = np.ones(len(mine), bool)
            while len(which):
                possible = matched + np.bincount(which, np.minimum(b - a, d - c), len(mine)).astype(np.int64)
                alive &= 2.0 * possible / total >= least
                on = alive[which]
                which, a, b, c, d = which[on], a[on], b[on], c[on], d[on]
                at, other, size = self._longest(chars, words, rows[which], a, b, c, d)
                matched += np.bincount(which, size, len(mine)).astype(np.int64)
                parts = [np.concatenate(x) for x in ((which, which), (a, at + size), (at, b), (c, other + size), (other, d))]
                on = np.concatenate([size, size]) > 0
                on &= (parts[1] < parts[2]) & (parts[3] < parts[4])
                which, a, b, c, d = (x[on] for x in parts)
            out[mine] = np.where(alive, 2.0 * matched / total, -1.0)
        self.scored += int((out >= 0).sum())
        return out

    def closest(self, title: str, part: int | None, floor: float = 0.0, at_once: int = 400) -> tuple[float, int | None]:
        """Score and id of the best title that reaches `floor`, of equal scores the least id; 0 and None where none does.

        A title may share at most the characters that both have. In falling order of that bound the others are scored, some at once, until
        none left can reach the best. Titles with another part number are none.
        """
        shared = np.minimum(self.counts, self.count(title)).sum(axis=1)
        bound = 2.0 * shared / (self.lengths + len(title))
        least = np.minimum(self.lengths, len(title))
        held = np.zeros(len(bound), bool)
        for i in np.flatnonzero((shared == least) & (least >= LEAST_CONTAINED)).tolist():
            held[i] = self.titles[i] in title or title in self.titles[i]
        bound[held] = CONTAINED
        if part is not None and part == part:
            bound[~np.isnan(self.parts) & (self.parts != part)] = 0.0
        best, chosen = floor, None
        order, size = np.lexsort((self.ids, -bound)), 16
        while len(order):
            of, order, size = order[:size], order[size:], min(4 * size, at_once)
            of = of[(bound[of] > 0) & (bound[of] >= best)]
            if not len(of):
                break
            score = np.full(len(of), CONTAINED)
            score[~held[of]] = self.ratios(title, of[~held[of]], best)
            found = float(score.max())
            if found > 0 and found >= best:
                first = int(self.ids[of[score == found]].min())
                chosen = first if found > best or chosen is None else min(first, chosen)
                best = found
        return (best, chosen) if chosen is not None else (0.0, None)


def _closest_in_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    titles = Titles(right["title"].tolist(), right["part"].tolist(), right["idx"].tolist())
    rows = []
    for t, p, floor in zip(left["title"], left["part"], left["floor"], strict=True) if len(right) else ():
        before = titles.scored
        score, idx = titles.closest(t, p, floor)
        rows.append((t, p, score, idx, titles.scored - before))
    return pd.DataFrame(rows, columns=["title", "part", "score", "idx", "scored"]).astype({"part": "Int32", "score": float, "idx": "Int64", "scored": "int64"})


def _grams(df: DataFrame, q: int = 3) -> DataFrame:
    """A row for each different q-gram of a title (the whole title, if it is shorter)."""
    places = F.sequence(F.lit(1), F.greatest(F.length("title") - (q - 1), F.lit(1)))
    return df.withColumn("gram", F.explode(F.array_distinct(F.transform(places, lambda i: F.substring("title", i, F.lit(q))))))


def floors(asked: DataFrame, known: DataFrame, rare: int = 6, most: int = 1000) -> DataFrame:
    """asked(title, part) with a column floor: the score of the candidate that shares most of the title's rarest q-grams, or 0.

    An inverted index from q-grams to known(title, part, idx), both distinct and cut; a title looks its `rare` rarest q-grams up, and of those only ones that at
    most `most` candidates have. What is found is only a score that the best one reaches, so leaving grams out loses nothing. Pairs hold numbers, no texts.
    """
    asked, known = asked.withColumn("_id", F.monotonically_increasing_id()), known.withColumn("_k", F.monotonically_increasing_id())
    index = _grams(known.withColumn("_l", F.length("title"))).select("gram", "_k", F.col("part").alias("other_part"), "_l", "idx")
    held = index.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") <= most)
    rarest = W.partitionBy("_id").orderBy("n", "gram")
    looked = _grams(asked).select("_id", "part", "gram").join(held, "gram").withColumn("_n", F.row_number().over(rarest)).filter(F.col("_n") <= rare).select("_id", "part", "gram")
    fits = F.coalesce(F.col("part") == F.col("other_part"), F.lit(True))
    pairs = looked.join(index, "gram").filter(fits).groupBy("_id", "_k", "_l", "idx").agg(F.count("*").alias("n"))
    seeds = pairs.groupBy("_id").agg(F.max_by("_k", F.struct("n", (-F.col("_l")).alias("l"), (-F.col("idx")).alias("i"))).alias("_k"))
    score = F.pandas_udf(lambda a, b: pd.Series([score_titles(x, y) for x, y in zip(a, b, strict=True)], dtype=float), "double")
    seeds = seeds.join(known.select("_k", F.col("title").alias("other")), "_k").join(asked.select("_id", "title"), "_id").select("_id", score("title", "other").alias("floor"))
    return asked.join(seeds, "_id", "left").select("title", "part", F.coalesce("floor", F.lit(0.0)).alias("floor"))


def closest_pairs(asked: DataFrame, known: DataFrame, titles_at_once: int = 256, candidates_at_once: int = 2000) -> DataFrame:
    """(title, part, score, idx, scored) of asked(title, part) and known(title, part, idx), both distinct: a row for each block of
    candidates that a title meets, idx null where none there reaches the title's floor; scored: how many ratios were worked out to the end.

    Titles and candidates are dealt to blocks by hash; each pair of blocks is one group of bounded size, and there are groups for all cores.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    asked, known = (cut(df.repartition(cores, "title")) for df in (asked, known))  # what they are made from is read once
    n, m = asked.count(), known.count()
    columns = max(1, -(-m // candidates_at_once))
    rows = max(1, -(-n // titles_at_once), min(n, -(-3 * cores // columns)))
    block = lambda k: F.pmod(F.xxhash64("title", "part"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    groups = min(rows * columns, max(20 * cores, rows * columns // 8))
    left = floors(asked, known).withColumn("row", block(rows)).withColumn("column", every(columns)).repartition(groups, "row", "column")
    right = known.withColumn("column", block(columns)).withColumn("row", every(rows)).repartition(groups, "row", "column")
    return left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(_closest_in_block, "title string, part int, score double, idx long, scored long")


def _plain(df: DataFrame, byline: str | None) -> DataFrame:
    return df.withColumns({"_t": normalize_title(F.col("title"), byline), "_part": part_number(F.col("title"))})


def distinct_titles(left: DataFrame, candidates: DataFrame, byline: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalised titles with their part numbers, each once, those of the candidates with the least idx."""
    asked = _plain(left, byline).filter("_t <> ''").select(F.col("_t").alias("title"), F.col("_part").alias("part")).distinct()
    return asked, _plain(candidates, byline).filter("_t <> ''").groupBy(F.col("_t").alias("title"), F.col("_part").alias("part")).agg(F.min("idx").alias("idx"))


def best_titles(left: DataFrame, candidates: DataFrame, byline: str | None = None, **blocks) -> DataFrame:
    """left(title, ...) with cand_idx, score: the best of candidates(idx, title), of equal scores the least idx.

    An index of q-grams gives each title a floor, a score that some candidate reaches; candidates are then scored in falling
    order of an upper bound until none can reach the floor or the best, and left as soon as they can't. Null titles, and titles that nothing
    resembles, get null and 0. blocks: sizes for closest_pairs.
    """
    found = closest_pairs(*distinct_titles(left, candidates, byline), **blocks).filter("idx IS NOT NULL")
    best = found.groupBy("title", "part").agg(F.max(F.struct("score", (-F.col("idx")).alias("last"))).alias("best"))
    out = _plain(left, byline).join(best.withColumnRenamed("title", "_title"), (F.col("_t") == F.col("_title")) & F.col("_part").eqNullSafe(F.col("part")), "left")
    return out.select(*(F.col(f"`{c}`") for c in left.columns), (-F.col("best.last")).alias("cand_idx"), F.coalesce("best.score", F.lit(0.0)).alias("score"))


def shared_grams(left: DataFrame, candidates: DataFrame, byline: str | None = None) -> DataFrame:
    """(title, shared, cand_idx): for each different title the most q-grams that a candidate shares with it, and the least such candidate.

    An integer form of the search, through the same index; titles that share none have no row. A frequent q-gram meets all its candidates.
    """
    asked, known = distinct_titles(left, candidates, byline)
    asked = cut(asked.select("title").distinct()).withColumn("_id", F.monotonically_increasing_id())  # pairs hold two numbers, no texts
    pairs = _grams(asked).select("gram", "_id").join(_grams(known).select("gram", "idx"), "gram").groupBy("_id", "idx").agg(F.count("*").alias("shared"))
    best = pairs.groupBy("_id").agg(F.max(F.struct("shared", (-F.col("idx")).alias("last"))).alias("best"))
    return best.join(asked, "_id").select("title", F.col("best.shared").alias("shared"), (-F.col("best.last")).alias("cand_idx"))


def counts_by_method(linked: DataFrame) -> DataFrame:
    return linked.groupBy("method").agg(F.count("*").alias("n"))


def unmatched(linked: DataFrame) -> DataFrame:
    return linked.filter("method = 'none'").select("filename", "rendered")


def candidate_union(manifest: DataFrame, dead: DataFrame) -> DataFrame:
    """(idx, title, url, type): the manifest's rows in their order, then those without a transcript that have a title."""
    rows = manifest.select("title", F.col("episode_url").alias("url"), "type", F.lit(0).alias("_src"))
    rows = rows.unionByName(dead.filter("title <> ''").select("title", F.col("episode_url").alias("url"), F.lit("no_transcript_available").alias("type"), F.lit(1).alias("_src")))
    return rows.withColumn("_at", F.monotonically_increasing_id()).select(((F.col("_src").cast("long") * (1 << 61)) + F.col("_at")).alias("idx"), "title", "url", "type")


def link(files: DataFrame, candidates: DataFrame, text_number: str, url_number: str, threshold: float = 0.5, byline: str | None = None) -> DataFrame:
    """files(filename, text) to candidates(idx, title, url, type): by the number in the text and in the URL, else by title.

    text_number, url_number: patterns whose group is the number. A number that no candidate has is method none and never
    fuzzy; of candidates with one number the last wins. The fuzzy threshold is inclusive.
    """
    last = W.partitionBy("num").orderBy(F.desc("idx"))
    index = candidates.withColumn("num", number_after(F.col("url"), url_number)).filter("num IS NOT NULL").withColumn("_n", F.row_number().over(last)).filter("_n = 1").select("num", F.col("idx").alias("_at"))
    base = files.withColumns({"num": number_after(F.col("text"), text_number), "word_count": word_count(F.col("text"))}).drop("text")
    exact = base.filter("num IS NOT NULL").join(index, "num", "left")
    exact = exact.select("filename", "word_count", F.col("_at").alias("cand_idx"), F.when(F.col("_at").isNotNull(), 1.0).alias("score"), F.when(F.col("_at").isNotNull(), "exact_number").otherwise("none").alias("method"), F.when(F.col("_at").isNull(), F.concat(F.lit("number_"), F.col("num").cast("string"), F.lit("_not_found"))).alias("status"))
    fuzzy = best_titles(base.filter("num IS NULL").withColumn("title", F.col("filename")), candidates, byline)
    ok = F.col("score") >= threshold
    fuzzy = fuzzy.select("filename", "word_count", F.when(ok, F.col("cand_idx")).alias("cand_idx"), "score", F.when(ok, "fuzzy_title").otherwise("none").alias("method"), F.lit(None).cast("string").alias("status"))
    return exact.unionByName(fuzzy).join(candidates.select(F.col("idx").alias("cand_idx"), "title", "url", "type"), "cand_idx", "left").withColumn("rendered", F.coalesce("status", F.format_string("%.2f", "score")))
