"""Best-fit packing by exact-complement hashing.

The plan works on the counts of piece lengths alone, of which there are at most `size`. Starting from the longest
length, the gap it leaves is looked up among single lengths, sums of two and sums of three; a combination
that fills the gap exactly is consumed as often as its counts allow. Where none is left, the longest length
that fits goes in and the rest of the gap is looked up again. Every step uses up a length or a combination, so the plan is
short, however many pieces there are. Pieces find their place by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, cut, map_rows, read

SIZE = 2048
#: The pieces of a length are dealt to groups of about so many by hash, so that no task ranks more, however common the length.
GROUP = 100_000


class Complements:
    """Counts by length, and which one, two or three lengths sum to a gap while there are enough of each."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.pair_of: dict[int, tuple[int, int]] = {}
        self.triple_of: dict[int, tuple[int, int, int]] = {}

    def holds(self, lengths: tuple[int, ...]) -> bool:
        return bool(lengths) and all(self.left[x] >= lengths.count(x) for x in set(lengths))

    def pair(self, gap: int) -> tuple[int, ...]:
        if not self.holds(self.pair_of.get(gap, ())):
            high = np.arange(gap - 1, (gap - 1) // 2, -1)
            ok = (self.left[high] > 0) & (self.left[gap - high] > 0) & ((2 * high != gap) | (self.left[high] > 1))
            at = np.flatnonzero(ok)
            self.pair_of[gap] = (int(high[at[0]]), int(gap - high[at[0]])) if len(at) else ()
        return self.pair_of[gap]

    def triple(self, gap: int) -> tuple[int, ...]:
        found = self.triple_of.get(gap)
        if found == ():  # counts only fall: what was not there stays away
            return ()
        if not self.holds(found or ()):
            self.triple_of[gap] = ()
            for x in np.flatnonzero(self.left[: gap - 1])[::-1].tolist():
                if 3 * x < gap:
                    break
                self.left[x] -= 1
                rest = self.pair(gap - x)
                self.left[x] += 1
                if rest and self.holds((x, *rest)):
                    self.triple_of[gap] = (x, *rest)
                    break
                if not rest:
                    self.pair_of.pop(gap - x, None)  # it was looked up with one x less
        return self.triple_of[gap]

    def exact(self, gap: int) -> tuple[int, ...]:
        return (gap,) if self.left[gap] else self.pair(gap) or self.triple(gap)


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), which use each of counts[length] pieces once."""
    c = Complements(np.asarray(counts, dtype=np.int64))
    out = []
    for longest in range(size, 0, -1):
        while c.left[longest]:
            c.left[longest] -= 1
            taken, gap = [longest], size - longest
            while gap:
                more = c.exact(gap)
                if not more:
                    below = np.flatnonzero(c.left[: gap + 1])
                    if not len(below):
                        break
                    more = (int(below[-1]),)
                for x in more:
                    c.left[x] -= 1
                taken += more
                gap -= sum(more)
            # As often again as the counts allow the same choice.
            used = {x: taken.count(x) for x in set(taken)}
            times = min(int(c.left[x]) // n for x, n in used.items())
            for x, n in used.items():
                c.left[x] -= times * n
            out.append((tuple(taken), times + 1))
    return out


class Places:
    """For each length: from which rank on which run of equal sequences takes it."""

    def __init__(self, runs: list[tuple[tuple[int, ...], int]]):
        rows: dict[int, list[tuple]] = {}
        taken: dict[int, int] = {}
        first = 0
        for lengths, times in runs:
            for x in set(lengths):
                starts = [sum(lengths[:i]) for i, y in enumerate(lengths) if y == x]
                rows.setdefault(x, []).append((taken.get(x, 0), first, starts))
                taken[x] = taken.get(x, 0) + times * len(starts)
            first += times
        self.rows = {x: (np.array([r[0] for r in v]), [r[1:] for r in v]) for x, v in rows.items()}
        self.sequences = first

    def find(self, length: int, rank: int) -> tuple[int, int]:
        """Sequence and offset."""
        begins, runs = self.rows[length]
        i = int(np.searchsorted(begins, rank, side="right")) - 1
        first, starts = runs[i]
        nth, slot = divmod(rank - int(begins[i]), len(starts))
        return first + nth, starts[slot]


def pieces_of(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; of several all have the full size but the first, which may be shorter."""
    if n <= size:
        return [(0, n)]
    short = n % size
    return ([(0, short)] if short else []) + [(i, size) for i in range(short, n, size)]


@lru_cache(maxsize=2)
def encoder(ranks_file: str, pattern: str, tokenizer_file: str, end_text: str = "<|endoftext|>", end_id: int = 50256):
    """The vocabulary through tiktoken, several times as fast as the same through tokenizers; the tests hold that the ids agree.

    Texts that tiktoken's expressions give up on (runs of about a million blanks) go through tokenizers.
    """
    import base64

    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={end_text: end_id})

    def encode(text: str) -> list[int]:
        try:
            return coding.encode(text, allowed_special="all")
        except ValueError:
            return slow_encoder(tokenizer_file).encode(text, add_special_tokens=False).ids

    return encode


@lru_cache(maxsize=2)
def slow_encoder(tokenizer_file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


def public_files() -> tuple[str, str, str]:
    """Ranks, pattern and tokenizer file of one public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")


def pieces(df: DataFrame, id_col: str, text_col: str, ranks_file: str, pattern: str, tokenizer_file: str, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row's ids, with id 0 at the end."""

    def rows(incoming):
        encode = encoder(ranks_file, pattern, tokenizer_file)
        for key, text in incoming:
            ids = np.array([*encode(text or ""), 0], dtype="<u4")
            for i, (start, n) in enumerate(pieces_of(len(ids), size)):
                yield key, i, start, n, zlib.crc32(ids[start : start + n].tobytes())

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, "doc_id long, piece int, start long, length long, ids_crc32 long", batch=5000)


def pack(cut_pieces: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """cut_pieces(doc_id, piece, start, length from 1 to size, ids_crc32) with sequence_id and offset.

    Pieces of the full size are sequences of their own, with negative numbers. Repeated rows are pieces of their own.
    cut_pieces must be cheap to read again (cut). To the driver come at most size + pieces / group counts.
    """
    spark = cut_pieces.sparkSession
    whole = cut_pieces.filter(F.col("length") == size).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut_pieces.filter(F.col("length") < size)
    often = {r.length: r["count"] for r in short.groupBy("length").count().collect()}
    groups = spark.createDataFrame([(n, -(-c // group)) for n, c in often.items()], "length long, _groups int")
    dealt = short.join(F.broadcast(groups), "length").withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_groups")).cast("int"))
    table = {n: np.zeros(-(-c // group), np.int64) for n, c in often.items()}
    for r in dealt.groupBy("length", "_group").count().collect():
        table[r.length][r["_group"]] = r["count"]
    before = {n: np.cumsum(c) - c for n, c in table.items()}
    counts = np.zeros(size + 1, np.int64)
    counts[list(often)] = list(often.values())
    places = Places(plan(counts, size))
    ranked = dealt.withColumn("_rank", F.row_number().over(W.partitionBy("_group", "length").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)

    def rows(incoming):
        for key, piece, start, length, crc, nth, rank in incoming:
            yield key, piece, start, length, crc, *places.find(length, int(before[length][nth]) + rank)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    schema = pa.schema([(n, pa.int32() if k == "int" else pa.int64()) for n, k in (x.split() for x in ddl.split(", "))])
    return map_rows(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_group", "_rank"), rows, schema, ddl, batch=10_000).unionByName(whole)


def pack_documents(df: DataFrame, ranks_file: str, pattern: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of df.

    Null and empty texts are the one id 0. Repeated rows are packed as often as they are there; other columns are
    ignored; an empty table has no sequence.
    """
    return pack(cut(pieces(df, id_col, text_col, ranks_file, pattern, tokenizer_file, size)), size)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), *public_files())
