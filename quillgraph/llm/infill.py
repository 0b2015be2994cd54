"""Fill-in-middle transformation by bit-parallel arithmetic on one big integer a text.

bytes.translate turns UTF-8 bytes into a string of 0 and 1 for a class of bytes, read as one integer whose highest bit is
the first byte. Shifted boolean operations on the masks mark where units (lines) begin, bit_count gives their number, and
recursive halving finds the place of the k-th unit. A document's id decides where it is cut and in which order it is put.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import col, map_rows, read

P, S, M = "<P>", "<S>", "<M>"


def _class_table(members: range | bytes) -> bytes:
    held = set(members)
    return bytes(ord("1") if b in held else ord("0") for b in range(256))


NEWLINE = _class_table(b"\n")
#: Bytes that begin a code point in UTF-8: all but the continuation bytes.
LEADING = _class_table([*range(0x80), *range(0xC0, 0x100)])


def mask(data: bytes, table: bytes) -> int:
    """One bit a byte, the first one highest."""
    return int(data.translate(table), 2) if data else 0


def line_starts(data: bytes) -> int:
    """Bits of the bytes at which a line `[^\\n]*\\n|[^\\n]+` begins: the first byte, and each one after a newline."""
    return (1 << len(data) - 1) | mask(data, NEWLINE) >> 1 if data else 0


def select(bits: int, width: int, rank: int) -> int:
    """Place, from the highest of `width` bits, of the set bit number `rank` (from 0); `width` where there are no more."""
    if rank >= bits.bit_count():
        return width
    at = 0
    while width > 1:
        low = width // 2
        high = bits >> low
        held = high.bit_count()
        if rank < held:
            bits, width = high, width - low
        else:
            rank, at = rank - held, at + width - low
            bits, width = bits & ((1 << low) - 1), low
    return at


def cut_units(data: bytes, first: int, second: int) -> tuple[int, int, int]:
    """Number of lines n, and the byte offsets at which `first` % (n+1) and `second` % (n+1) lines end, the smaller one first."""
    starts = line_starts(data)
    n = starts.bit_count()
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, select(starts, len(data), a), select(starts, len(data), b)


@dataclass(frozen=True)
class Infill:
    """seed: of the draws; rate: percent of the documents to transform; spm: percent of these that put the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50

    def draws(self, doc_id: int | None) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]

    def apply(self, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
        """(n, form, prefix_chars, middle_chars, output)."""
        data = text.encode()
        h1, h2, h3, h4 = self.draws(doc_id)
        n, a, b = cut_units(data, h1, h2)
        if not text or P in text or S in text or M in text or h3 % 100 >= self.rate:
            return n, "plain", None, None, text
        lead = mask(data, LEADING)
        prefix_chars = (lead >> len(data) - a).bit_count()
        middle_chars = (lead >> len(data) - b).bit_count() - prefix_chars
        prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
        if h4 % 100 < self.spm:
            return n, "spm", prefix_chars, middle_chars, f"{S}{suffix}{P}{prefix}{M}{middle}"
        return n, "psm", prefix_chars, middle_chars, f"{P}{prefix}{S}{suffix}{M}{middle}"


def restore(form: str, output: str) -> str:
    """The text that gave `output`. A marker never begins within the part before it, so its first occurrence is the marker."""
    if form == "plain":
        return output
    one, two = (P, S) if form == "psm" else (S, P)
    middle_at = output.index(M)
    two_at = output.index(two, len(one))
    first, second, middle = output[len(one) : two_at], output[two_at + len(two) : middle_at], output[middle_at + len(M) :]
    return first + middle + second if form == "psm" else second + middle + first


def fill_in_middle(df: DataFrame, id_col: str, text_col: str, infill: Infill = Infill()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row: whole texts, cut between lines.

    Null texts count as empty, and empty ones stay plain, as do texts that hold a marker. A null id draws from the seed alone.
    Repeated rows stay repeated, and equal ids with equal texts give equal rows; other columns are ignored, an empty table stays
    empty. Time is in proportion to the text, however long.
    """

    def rows(incoming):
        for key, text in incoming:
            yield key, *infill.apply(key, text or "")

    ddl = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (x.split() for x in ddl.split(", "))])
    return map_rows(df.select(col(id_col).cast("long"), col(text_col).cast("string")), rows, schema, ddl, batch=500)


def restored(df: DataFrame, form_col: str = "form", output_col: str = "output", name: str = "restored") -> DataFrame:
    """df with a column of the texts that its outputs were made of; null outputs give null."""

    @F.pandas_udf("string")
    def rebuild(form, output):
        return output.__class__([None if o is None else restore(f, o) for f, o in zip(form, output, strict=True)], dtype=object)

    return df.withColumn(name, rebuild(col(form_col), col(output_col)))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(read(spark, sf_dir, "documents"), "doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
  FROM t),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, text, n, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
