"""Fill-in-middle transformation with cuts found in a Fenwick tree.

A text is a sequence of units (a run of ASCII letters, or any other code point).
Its UTF-8 bytes are divided into blocks of ``BLOCK``; one Fenwick tree over the
blocks holds how many units begin in them, another how many code points.  A cut
behind k units is where unit k + 1 begins: a binary-lifting descent finds the
block in which the count passes k, and only that block is searched for the place.
The code points before a cut are a prefix sum of the second tree and a count
inside the block.

Prefix, middle and suffix are written in the order of the form (``psm`` or
``spm``) behind the marks ``<P>``, ``<S>`` and ``<M>``; a text that holds a mark, is
empty, or is drawn to stay is ``plain``.  No mark can begin inside another one, so
the marks of an output stand exactly once and ``restored`` is found from output and
form alone.

Defined results: a null text is empty; a null id draws with the empty word; equal
rows are transformed alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, ship, slices
from eventrollup.llm.words import text_bytes

BLOCK = 512                       # bytes
SEED = "1"
FIM_PERCENT, SPM_PERCENT = 90, 20
MARKS = ("<P>", "<S>", "<M>")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


class Fenwick:
    """Prefix sums of counts, and the block in which a sum passes a number."""

    def __init__(self, counts: np.ndarray):
        # Node i holds the sum of the lowbit(i) counts that end at i.
        total = np.concatenate([[0], np.cumsum(counts)])
        i = np.arange(len(total))
        self.node = (total - total[i - (i & -i)]).tolist()
        self.top = 1 << max(len(counts).bit_length() - 1, 0)

    def prefix(self, n: int) -> int:
        """Sum of the first ``n`` counts."""
        out = 0
        while n:
            out += self.node[n]
            n &= n - 1
        return out

    def descend(self, k: int) -> tuple[int, int]:
        """(n, rest): the most leading counts whose sum is at most ``k``, and k
        less that sum."""
        at, step = 0, self.top
        while step:
            if at + step < len(self.node) and self.node[at + step] <= k:
                at += step
                k -= self.node[at]
            step >>= 1
        return at, k


def starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte: does a code point, does a unit begin here?"""
    points = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    after = np.zeros(len(data), dtype=bool)
    after[1:] = letter[:-1]
    begins = offsets[:-1]
    after[begins[begins < len(data)]] = False
    return points, points & ~(letter & after)


class Cuts:
    """The two trees of one text."""

    def __init__(self, points: np.ndarray, units: np.ndarray, block: int = BLOCK):
        self.points, self.units, self.block, self.size = points, units, block, len(points)
        edges = np.arange(0, len(points), block)
        self.n_units = int(units.sum())
        empty = np.zeros(0, np.int64)
        self.by_unit = Fenwick(np.add.reduceat(units, edges, dtype=np.int64) if len(edges) else empty)
        self.by_point = Fenwick(np.add.reduceat(points, edges, dtype=np.int64) if len(edges) else empty)

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code points before it) of the place behind ``k`` units."""
        if k >= self.n_units:
            return self.size, self.by_point.prefix(len(self.by_point.node) - 1)
        n, rest = self.by_unit.descend(k)
        first = n * self.block
        at = first + int(np.flatnonzero(self.units[first:first + self.block])[rest])
        return at, self.by_point.prefix(n) + int(self.points[first:at].sum())


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, h1, h2, plain, spm -> the transformed texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.string())])
    p, s, m = (x.encode() for x in MARKS)
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column(1))
        points, units = starts(data, offsets)
        whole = data.tobytes()
        ids, h1, h2, plain, spm = (batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5))
        out = []
        for i in range(batch.num_rows):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            text = whole[lo:hi]
            cuts = Cuts(points[lo:hi], units[lo:hi])
            n = cuts.n_units
            if plain[i] or any(x in text for x in (p, s, m)):
                out.append((ids[i], n, "plain", None, None, text))
                continue
            first, second = sorted((h1[i] % (n + 1), h2[i] % (n + 1)))
            a, before = cuts.cut(first)
            b, upto = cuts.cut(second)
            if spm[i]:
                form, made = "spm", s + text[b:] + p + text[:a] + m + text[a:b]
            else:
                form, made = "psm", p + text[:a] + s + text[b:] + m + text[a:b]
            out.append((ids[i], n, form, before, upto - before, made))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, f.type) for c, f in zip(columns[:5], schema, strict=False)),
             pa.array(columns[5], pa.binary()).cast(pa.string())], schema=schema)


def transform(docs: DataFrame, seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n, form, prefix_chars, middle_chars, output."""
    ship(docs.sparkSession)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), draw.alias("h"))

    def part(k: int) -> Column:
        return F.conv(F.substring("h", 8 * k - 7, 8), 16, 10).cast("bigint")

    drawn = d.select("doc_id", "text", part(1).alias("h1"), part(2).alias("h2"),
                     ((F.col("text") == "") | (part(3) % 100 >= fim_percent)).alias("plain"),
                     (part(4) % 100 < spm_percent).alias("spm"))
    return drawn.mapInArrow(_transform, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text, from the output and its form."""
    out, p, s, m = F.col(output), *MARKS
    middle = F.substring_index(out, m, -1)
    head = F.substring_index(out, m, 1)           # both other parts, each behind its mark
    by_p, by_s = F.substring_index(head, p, -1), F.substring_index(head, s, -1)
    psm = F.concat(F.substring_index(by_p, s, 1), middle, by_s)
    spm = F.concat(by_p, middle, F.substring_index(by_s, p, 1))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(read_input(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))
