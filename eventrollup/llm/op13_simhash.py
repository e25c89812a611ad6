"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has bit b set if more than half of the XXH64 values (seed
42) of its four-word shingles, repeats included, have it set.  Fingerprints that
differ in at most ``RADIUS`` bits are linked.

Candidates: 64 bits are divided into ``PARTS`` = RADIUS + 2 parts.  Two linked
fingerprints differ in at most RADIUS of them, so they agree on two parts at
least: every distinct fingerprint goes into one bucket for each pair of parts
(keys of 20 to 22 bits), and no link is lost.  A bucket of more than ``TILE``
fingerprints is dealt into tiles, and every two tiles meet in a group of their
own, so no task holds more than two tiles of one bucket and nothing is left out.

Comparison: the fingerprints of many buckets stand in a row of lanes, bucket
after bucket, and are turned into 64 bit planes.  For a distance d, all lanes are
compared at once with the lane d further on: each plane's difference is added to
vertical carry-save counters, and words of 64 lanes drop out as soon as all of
their counts exceed the radius.  Lanes whose two fingerprints are known to be
connected are not compared, so a bucket gives a spanning forest, not its pairs.

Components of the forest's edges are found in Spark tables; the name of a
component is its smallest document id.

Defined results: a null or blank text has the fingerprint zero and is linked
like any other; equal rows share their fingerprint; rows without an id get their
component's smallest id, null if no member has one; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, ship, slices, store
from eventrollup.llm.components import components
from eventrollup.llm.words import text_bytes

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 8192                       # fingerprints of one bucket compared as one group
LANES = 65536                     # fingerprints compared at once, several buckets
HASHES = 65536                    # shingles of one text counted at once
PLANES_A_STEP = 6                 # planes between two looks at the counters

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))
_U = np.uint64


# --- fingerprints -------------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    """(n, 64) bits of 64-bit values, the lowest first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line, size = b" ".join(words), np.array([len(w) for w in words])
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    k = min(shingle, len(words))
    spans = zip(start[:len(words) - k + 1].tolist(), stop[k - 1:].tolist(), strict=True)
    digest, n, counts, some = xxhash.xxh64_intdigest, len(words) - k + 1, np.zeros(64, np.int64), []
    for a, b in spans:
        some.append(digest(line[a:b], SEED))
        if len(some) == HASHES:
            counts += _bits(np.array(some, _U)).sum(axis=0, dtype=np.int64)
            some = []
    if some:
        counts += _bits(np.array(some, _U)).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column(1))
        whole, at = data.tobytes(), offsets.tolist()
        prints = np.array([fingerprint(whole[a:b]) for a, b in zip(at, at[1:], strict=False)], _U)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, print (the fingerprint as a signed long)."""
    ship(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return d.mapInArrow(_fingerprints, "doc_id bigint, print bigint")


# --- candidates -----------------------------------------------------------------

def parts(radius: int = RADIUS) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 2 parts of the fingerprint."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def buckets(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Each fingerprint once for every pair of parts: (bucket, print)."""
    def field(first: int, bits: int) -> Column:
        return F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << bits) - 1))

    keys = []
    for k, ((a, m), (b, n)) in enumerate(combinations(parts(radius), 2)):
        # The number of the pair of parts leads: at most 22 bits follow it.
        keys.append(F.shiftleft(field(a, m), n) + field(b, n) + F.lit(k << 32))
    return prints.select("print", F.explode(F.array(*keys)).alias("bucket")).select("bucket", "print")


def groups(dealt: DataFrame, tile: int = TILE) -> DataFrame:
    """(bucket, print) -> (bucket, pair, print) with groups of two tiles at most."""
    big = store(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile), "simhash-big")
    whole = dealt.withColumn("pair", F.lit(0).cast("bigint"))
    if big.isEmpty():
        return whole
    tiles = F.ceil(F.col("n") / tile)
    held = dealt.join(big.select("bucket", tiles.alias("tiles")), "bucket", "left")
    mine = F.pmod(F.xxhash64("print"), F.col("tiles"))
    # A tile meets every other one: pair (i, j) with i < j.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    split = held.where(F.col("tiles").isNotNull()).withColumn("mine", mine).withColumn("other", other) \
        .where(F.col("mine") != F.col("other"))
    pair = F.least("mine", "other") * F.col("tiles") + F.greatest("mine", "other")
    return held.where(F.col("tiles").isNull()).select("bucket", F.lit(0).cast("bigint").alias("pair"), "print") \
        .unionByName(split.select("bucket", pair.alias("pair"), "print"))


# --- bit-sliced comparison --------------------------------------------------------

def planes_of(values: np.ndarray, words: int) -> np.ndarray:
    """(64, words) bit planes: bit i of word w of plane b is bit b of value 64 w + i."""
    bits = np.zeros((64, words * 64), np.uint8)
    bits[:, :len(values)] = _bits(values).T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def near(planes: np.ndarray, d: int, lanes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Of the words' ``lanes`` (a mask of 64-bit words), those whose value differs
    from the one ``d`` lanes further on in at most ``radius`` bits.  The planes
    have enough words of zeros behind the last lane.

    ``radius`` is at most 6: three counter planes and one that says "more".
    """
    at = np.flatnonzero(lanes)
    alive = lanes[at].copy()
    skip, shift = divmod(d, 64)
    one, two, four, more = (np.zeros(len(at), _U) for _ in range(4))
    for b in range(64):
        plane = planes[b]
        ahead = plane[at + skip]
        if shift:
            ahead = (ahead >> _U(shift)) | (plane[at + skip + 1] << _U(64 - shift))
        x = plane[at] ^ ahead
        carry = one & x
        one ^= x
        x = two & carry
        two ^= carry
        more |= four & x
        four ^= x
        if b % PLANES_A_STEP == PLANES_A_STEP - 1 or b == 63:
            alive &= ~(more | _beyond(one, two, four, radius))
            if not alive.all():
                keep = np.flatnonzero(alive)
                if not len(keep):
                    break
                at, alive = at[keep], alive[keep]
                one, two, four, more = one[keep], two[keep], four[keep], more[keep]
    out = np.zeros(len(lanes), _U)
    out[at] = alive
    return out


def _beyond(one: np.ndarray, two: np.ndarray, four: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-plane count exceeds ``radius`` (0 to 6)."""
    # Compare from the highest plane down.
    above, equal = np.zeros_like(one), ~np.zeros_like(one)
    for plane, bit in ((four, radius >> 2 & 1), (two, radius >> 1 & 1), (one, radius & 1)):
        if bit:
            equal = equal & plane
        else:
            above = above | (equal & plane)
            equal = equal & ~plane
    return above


def forest(values: np.ndarray, sizes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of buckets that stand one after another: (a, b) lanes.

    ``sizes`` are the buckets' sizes in the order of ``values``; larger ones
    come first, so the lanes still at work for a large d lie together.
    """
    n = len(values)
    words = -(-n // 64)
    top = int(sizes[0]) if len(sizes) else 0
    planes = planes_of(values, words + top // 64 + 2)
    stop = np.repeat(np.cumsum(sizes), sizes)
    room = stop - np.arange(n) - 1                     # lanes behind this one in its bucket
    up = np.arange(n)
    left, right = [], []
    for d in range(1, top):
        on = room >= d
        here = np.flatnonzero(on)
        if not len(here):
            break
        # Connected already: nothing to learn from comparing them.
        here = here[up[here] != up[here + d]]
        if not len(here):
            if _one_each(up, sizes):
                break
            continue
        mask = np.zeros(words * 64, np.uint8)
        mask[here] = 1
        found = near(planes, d, np.packbits(mask, bitorder="little").view("<u8"), radius)
        hits = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
        if len(hits):
            a, b = _join(up, hits, hits + d)
            left.append(a)
            right.append(b)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _one_each(up: np.ndarray, sizes: np.ndarray) -> bool:
    """Is every bucket one component?"""
    first = np.cumsum(sizes) - sizes
    return bool((up == np.repeat(up[first], sizes)).all())


def _join(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the components of linked lanes in ``up`` (lane -> its root, always
    flat); returns the links that joined two."""
    roots: dict[int, int] = {}

    def find(x: int) -> int:
        while x in roots:
            x = roots[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(up[a].tolist(), up[b].tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            roots[max(x, y)] = min(x, y)
            kept.append(i)
    moved = np.array(sorted(roots), np.int64)
    if len(moved):
        to = np.array([find(int(x)) for x in moved], np.int64)
        at = np.searchsorted(moved, up)
        at[at == len(moved)] = 0
        change = moved[at] == up
        up[change] = to[at[change]]
    return a[kept], b[kept]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints sorted by (bucket, pair) -> links of every bucket's forest."""
    def compared(key, values):
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        first = np.concatenate([[0], cut])
        size = np.diff(np.append(first, len(key)))
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 1]
        if not len(order):
            return
        size = size[order]
        lanes = np.repeat(first[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        values = values[lanes]
        a, b = forest(values.view(_U), size)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(values[a]), pa.array(values[b])], names=["a", "b"])

    key, values = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        more = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
        key, values = np.concatenate([key, more]), np.concatenate([values, batch.column(2).to_numpy()])
        while len(key) > LANES:
            # Whole buckets only: up to the last boundary, or the whole of the first.
            change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            within = change[change <= LANES]
            if not len(change):
                break
            at = int(within[-1]) if len(within) else int(change[0])
            yield from compared(key[:at], values[:at])
            key, values = key[at:], values[at:]
    if len(key):
        yield from compared(key, values)


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (print) -> links (a, b) that connect the same
    fingerprints as all pairs within the radius do."""
    ship(prints.sparkSession)
    dealt = groups(buckets(prints, radius), tile).repartition("bucket", "pair").sortWithinPartitions("bucket", "pair", "print")
    return dealt.select("bucket", "pair", "print").mapInArrow(_compare, "a bigint, b bigint")


def classes(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, print, component_id, one row per document."""
    marked = store(fingerprints(docs), "simhash-prints")
    # One row per distinct fingerprint, whatever the number of its copies.
    lowest = store(marked.groupBy("print").agg(F.min("doc_id").alias("lowest")), "simhash-distinct")
    found = store(links(lowest.select("print")), "simhash-links")
    named = components(found)
    labelled = lowest.join(named, lowest["print"] == named["node"], "left") \
        .select("print", F.coalesce("component", "print").alias("component"), "lowest")
    smallest = labelled.groupBy("component").agg(F.min("lowest").alias("component_id"))
    names = store(labelled.join(smallest, "component").select("print", "component_id"), "simhash-names")
    return marked.join(names, "print").select("doc_id", "print", "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(read_input(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
