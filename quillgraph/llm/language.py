"""Language identification by rank-order profiles.

A profile is the `top` most frequent character n-grams (orders 1 to 3) of all texts of a language, by rank. A document's own
most frequent n-grams are compared with each profile by the out-of-place distance: the sum of the differences of rank,
`top` for an n-gram that the profile lacks. The nearest language wins. N-grams are taken from lower-cased letters,
where each run of other characters stands as one blank.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import col, map_rows, read

UNKNOWN = "und"
_BLANK, _BITS = 32, 21  # a code point fits 21 bits, so three fit a long; no code point here is 0
_CHUNK = 1 << 20
_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one blank before, after and between runs."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    codes = np.where(_letter_table()[codes], codes, _BLANK)
    keep = codes != _BLANK
    keep[1:] |= codes[:-1] != _BLANK
    keep[0] = True
    return codes[keep]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as longs, rising, and their counts; none without a letter. Long texts are counted piece by piece."""
    codes = letters(text)
    if len(codes) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    for at in range(0, len(codes), _CHUNK):
        part = codes[at : at + _CHUNK + 2]  # an n-gram belongs to the piece in which it begins
        own = min(_CHUNK, len(codes) - at)
        pairs = (part[:-1] << _BITS) | part[1:]
        triples = (pairs[:-1] << _BITS) | part[2:]
        ones = part[:own]
        values = np.sort(np.concatenate([ones[ones != _BLANK], pairs[:own], triples[:own]]))
        found.append(_counted(values, np.ones(len(values), np.int64)))
    if len(found) == 1:
        return found[0]
    values, n = np.concatenate([v for v, _ in found]), np.concatenate([n for _, n in found])
    order = np.argsort(values, kind="stable")
    return _counted(values[order], n[order])


def _counted(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(n, first) if len(first) else np.zeros(0, np.int64)


def ranked(values: np.ndarray, n: np.ndarray, top: int) -> np.ndarray:
    """The `top` most frequent, ties to the smaller n-gram."""
    if len(n) > 4 * top:  # narrow to those at or above the count of the last place
        least = np.partition(n, len(n) - top)[len(n) - top]
        values, n = values[n >= least], n[n >= least]
    return values[np.argsort(-n, kind="stable")[:top]]


@dataclass(frozen=True)
class LanguageProfiles:
    """profiles: of each language, its n-grams from the most frequent on. Ties of distance go to the first language by name."""

    profiles: dict[str, list[int]]
    top: int = 300
    _index: dict = field(default_factory=dict, repr=False, compare=False)

    def _matrix(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        if not self._index:
            names = sorted(self.profiles)
            union = np.unique(np.array([g for p in self.profiles.values() for g in p], dtype=np.int64))
            ranks = np.full((len(names), len(union) + 1), -1, dtype=np.int64)  # last column: in no profile
            for i, name in enumerate(names):
                ranks[i, np.searchsorted(union, np.array(self.profiles[name], dtype=np.int64))] = np.arange(len(self.profiles[name]))
            self._index["all"] = names, union, ranks
        return self._index["all"]

    def distances(self, text: str) -> tuple[list[str], np.ndarray, int]:
        """Languages, their distances from the text, and the greatest distance there can be (0 for a text without letters)."""
        names, union, ranks = self._matrix()
        own = ranked(*grams(text), self.top)
        at = np.searchsorted(union, own)
        at[at == len(union)] = 0
        at = np.where(union[at] == own, at, len(union)) if len(union) else at
        there = ranks[:, at]
        return names, np.where(there >= 0, np.abs(there - np.arange(len(own))), self.top).sum(axis=1), self.top * len(own)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - distance / greatest distance); (und, 0.0) for null, for no letter, and where nothing was learnt."""
        if not text or not self.profiles:
            return UNKNOWN, 0.0
        names, distance, most = self.distances(text)
        if not most:
            return UNKNOWN, 0.0
        best = int(np.argmin(distance))
        return names[best], round(float(1 - distance[best] / most), 6)


def learn_profiles(df: DataFrame, text_col: str, lang_col: str, top: int = 300, held: int = 500_000, salts: int = 64) -> LanguageProfiles:
    """Profiles from all rows of df with a text and a language: n-grams are counted in the tasks (at most about `held` at a time) and
    summed by Spark; the best of each language are taken by salt first, so no task sees all n-grams of a language.

    The driver gets `top` n-grams a language. Rows with null text or language don't count, texts without a letter add
    nothing, repeated rows count as often as they are there. Ties of counts go to the smaller n-gram. Without rows there is no profile.
    """

    def counts(incoming):
        kept: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in kept.items():
                values, n = np.concatenate([v for v, _ in parts]), np.concatenate([n for _, n in parts])
                order = np.argsort(values, kind="stable")
                for v, c in zip(*(x.tolist() for x in _counted(values[order], n[order])), strict=True):
                    yield lang, v, c
            kept.clear()

        for lang, text in incoming:
            values, n = grams(text)
            kept.setdefault(lang, []).append((values, n))
            size += len(values)
            if size > held:
                yield from flush()
                size = 0
        yield from flush()

    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    rows = df.select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text")).dropna()
    total = map_rows(rows, counts, schema, "lang string, gram long, n long", batch=50_000).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = lambda frame, *keys: frame.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= top)
    best = first(first(total.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(salts))), "lang", "salt"), "lang")
    profiles: dict[str, list[int]] = {}
    for r in sorted(best.select("lang", "rank", "gram").collect()):
        profiles.setdefault(r.lang, []).append(r.gram)
    return LanguageProfiles(profiles, top)


def identify(df: DataFrame, profiles: LanguageProfiles, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, lang_pred, score) for each row, from its whole text alone.

    Null texts and texts without a letter are `und` with score 0. Repeated rows stay repeated, equal texts get equal answers;
    other columns are ignored; an empty table stays empty. Long texts are counted in pieces.
    """

    def rows(incoming):
        for key, text in incoming:
            yield key, *profiles.predict(text)

    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, "doc_id long, lang_pred string, score double")


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    """Four of five documents, by crc32 of the id, are learnt from; a null id counts as empty text, whose remainder is 0."""
    docs = read(spark, sf_dir, "documents")
    fold = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == 0
    profiles = learn_profiles(docs.filter(~fold(F.col("doc_id"))), "text", "lang")
    found = identify(docs, profiles, "doc_id", "text")
    return found.select("doc_id", fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
