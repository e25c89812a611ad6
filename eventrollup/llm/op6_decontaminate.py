"""Benchmark decontamination with a distributed positional inverted index.

Build: tasks cut their documents into segments of bounded size.  A segment is
one row of a stored table: its documents, its sorted terms (64-bit hashes of
lower-cased words) and, for every term, the ascending positions of all its
occurrences.  Positions of neighbouring documents lie ``GAP`` apart, so no
match crosses a text.  The index is partitioned by documents: building and
searching it shuffle nothing, and a frequent term is spread over all segments.

Search: a phrase starts from the posting list of its rarest term in the
segment; the lists of its other terms, shifted by their offsets, are
intersected with it from rare to frequent.  All phrases of a query block do
this together on flat arrays.  ``proximity`` finds terms lying together within
a number of words.

The query set is read in blocks of bounded size; each block goes to the tasks
and passes over the index, so the benchmark may be of any size.

Defined results: null and empty texts (documents or items) have no words, no
windows and no hits; an item without an id counts under the empty id; repeated
documents are separate rows, repeated items count once per id; an empty table
gives no rows (documents) or no hits (benchmark); other columns are not read.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm import words as W
from eventrollup.llm.common import read_input, ship, slices, store

WINDOW = 13
GAP = 64                      # longest phrase or proximity span
SEGMENT_WORDS = 500_000       # words of a segment; one longer text is one segment
BLOCK_WORDS = 2_000_000       # words of the queries that a task holds at once

INDEX_SCHEMA = ("doc_ids array<bigint>, n_words binary, terms binary, counts binary, postings binary")
HITS_SCHEMA = ("segment bigint, ord int, doc_id bigint, n_words bigint, "
               "spans array<struct<start:bigint,stop:bigint>>, items array<string>")


def _planes(values: np.ndarray) -> bytes:
    """32-bit values with equal bytes of all values side by side (they compress better)."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(body: bytes) -> np.ndarray:
    flat = np.frombuffer(body, dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<u4").ravel()


def _segment(doc_ids: list, hashes: np.ndarray, n_words: np.ndarray) -> dict:
    position = np.arange(len(hashes), dtype=np.int64) + np.repeat(np.arange(len(n_words)) * GAP, n_words)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    postings = position[order]
    gaps = np.diff(postings, prepend=0)
    gaps[begin] = postings[begin]
    return {"doc_ids": doc_ids, "n_words": n_words.astype("<i8").tobytes(),
            "terms": ordered[begin].astype("<u8").tobytes(),
            "counts": _planes(np.diff(np.append(begin, len(ordered)))), "postings": _planes(gaps)}


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n_words", pa.binary()), ("terms", pa.binary()),
                        ("counts", pa.binary()), ("postings", pa.binary())])
    ids: list = []
    hashes: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held = 0
    for batch in slices(batches):
        data, offsets = W.text_bytes(batch.column(1))
        starts, ends, first = W.word_spans(data, offsets, W.ALPHANUMERIC)
        ids += batch.column(0).to_pylist()
        hashes.append(W.word_hashes(data, starts, ends))
        counts.append(np.diff(first))
        held += len(starts)
        if held >= SEGMENT_WORDS:
            yield pa.RecordBatch.from_pylist([_segment(ids, np.concatenate(hashes), np.concatenate(counts))], schema=schema)
            ids, hashes, counts, held = [], [], [], 0
    if ids:
        yield pa.RecordBatch.from_pylist([_segment(ids, np.concatenate(hashes), np.concatenate(counts))], schema=schema)


def build_index(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> the stored index, one row per segment."""
    ship(docs.sparkSession)
    return store(docs.select("doc_id", "text").mapInArrow(_index_batches, INDEX_SCHEMA), "positional-index")


class Segment:
    """One decoded row of the index."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.n_words = np.frombuffer(row["n_words"], dtype="<i8")
        self.terms = np.frombuffer(row["terms"], dtype="<u8")
        counts = _unplanes(row["counts"]).astype(np.int64)
        self.counts = counts
        self.begin = np.cumsum(counts) - counts
        gaps = _unplanes(row["postings"]).astype(np.int64)
        total = np.cumsum(gaps)
        base = np.where(self.begin > 0, total[np.maximum(self.begin - 1, 0)], 0) if len(counts) else counts
        self.postings = total - np.repeat(base, counts)
        # (term, position) as one ascending number.
        self.keys = (np.repeat(np.arange(len(counts), dtype=np.int64), counts) << 34) | self.postings
        self.doc_first = np.cumsum(self.n_words) - self.n_words + np.arange(len(self.n_words)) * GAP

    def ordinals(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term in the dictionary, -1 if the segment lacks it."""
        if not len(self.terms):
            return np.full(len(terms), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def phrases(self, ords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of all occurrences; ``ords`` is a phrase per row."""
        alive = np.flatnonzero((ords >= 0).all(axis=1))
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ords = ords[alive]
        order = np.argsort(self.counts[ords], axis=1, kind="stable")
        rows = np.arange(len(ords))
        rare = ords[rows, order[:, 0]]
        size = self.counts[rare]
        which = np.repeat(rows, size)
        start = self.postings[np.repeat(self.begin[rare], size) + W.ramp(size)] - order[which, 0]
        for k in range(1, ords.shape[1]):
            col = order[which, k]
            want = (ords[which, col] << 34) | (start + col)
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = (self.keys[at] == want) & (start >= 0)
            which, start = which[ok], start[ok]
            if not len(which):
                break
        return alive[which], start

    def near(self, ords: np.ndarray, span: int) -> np.ndarray:
        """Positions of the rarest of the terms that lie in some run of ``span``
        words holding all the terms."""
        if not len(ords) or (ords < 0).any():
            return np.zeros(0, np.int64)
        ords = ords[np.argsort(self.counts[ords], kind="stable")]
        lead = self.postings[self.begin[ords[0]]:self.begin[ords[0]] + self.counts[ords[0]]]
        left = lead[:, None] - np.arange(span)[None, :]
        ok = np.ones(left.shape, dtype=bool)
        for o in ords[1:]:
            own = self.postings[self.begin[o]:self.begin[o] + self.counts[o]]
            at = np.searchsorted(own, left)
            ok &= (at < len(own)) & (own[np.minimum(at, len(own) - 1)] <= left + span - 1)
        return lead[ok.any(axis=1)]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_first, positions, side="right") - 1


class Phrases:
    """A block of phrases: distinct terms, and for each length the phrases as
    rows of term numbers with the items they belong to."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        flat: dict[int, dict[bytes, set[str]]] = {}
        for name, hashes in items:
            n = len(hashes)
            size = min(n, window)
            for i in range(max(1, n - window + 1) if n else 0):
                flat.setdefault(size, {}).setdefault(hashes[i:i + size].tobytes(), set()).add(name)
        every = {size: np.frombuffer(b"".join(rows), dtype=np.uint64).reshape(-1, size) for size, rows in flat.items()}
        self.terms = np.unique(np.concatenate([m.ravel() for m in every.values()])) if every else np.zeros(0, np.uint64)
        self.groups = [(size, np.searchsorted(self.terms, m), [sorted(x) for x in flat[size].values()])
                       for size, m in every.items()]


def _hits(segment: Segment, block: Phrases) -> list[tuple[list, list]]:
    """For each document of the segment: merged word spans hit, and items."""
    n = len(segment.n_words)
    spans: list[list] = [[] for _ in range(n)]
    items: list[set] = [set() for _ in range(n)]
    ords = segment.ordinals(block.terms)
    begin, stop = [], []
    for size, rows, names in block.groups:
        which, start = segment.phrases(ords[rows])
        begin.append(start)
        stop.append(start + size)
        pairs = np.unique(np.stack([segment.doc_of(start), which]), axis=1) if len(which) else np.zeros((2, 0), np.int64)
        for d, w in pairs.T:
            items[d].update(names[w])
    if begin and sum(map(len, begin)):
        a, b = np.concatenate(begin), np.concatenate(stop)
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        new = np.ones(len(a), dtype=bool)
        new[1:] = a[1:] > b[:-1]
        at = np.flatnonzero(new)
        a, b = a[at], b[np.append(at[1:], len(b)) - 1]
        doc = segment.doc_of(a)
        for d, x, y in zip(doc, a - segment.doc_first[doc], b - segment.doc_first[doc], strict=True):
            spans[d].append({"start": int(x), "stop": int(y)})
    return [(spans[i], sorted(items[i])) for i in range(n)]


def _searcher(block: Phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("segment", pa.int64()), ("ord", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                            ("items", pa.list_(pa.string()))])
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                segment = Segment(row)
                found = _hits(segment, block)
                yield pa.RecordBatch.from_pydict({
                    "segment": [row["segment"]] * len(found), "ord": list(range(len(found))),
                    "doc_id": segment.doc_ids, "n_words": segment.n_words.tolist(),
                    "spans": [s for s, _ in found], "items": [x for _, x in found]}, schema=schema)
    return run


def item_blocks(items: DataFrame, key: str = "item_id", max_words: int = BLOCK_WORDS) -> Iterator[list]:
    """Blocks of (id, word hashes) of at most ``max_words`` words (one item at
    least), fetched one partition of the query set at a time."""
    block: list = []
    held = 0
    for row in items.select(F.coalesce(F.col(key).cast("string"), F.lit("")), "text").toLocalIterator():
        data, offsets = W.text_bytes(pa.array([row[1]], pa.string()))
        starts, ends, _ = W.word_spans(data, offsets, W.ALPHANUMERIC)
        if block and held + len(starts) > max_words:
            yield block
            block, held = [], 0
        block.append((row[0], W.word_hashes(data, starts, ends)))
        held += len(starts)
    yield block


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, max_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document of the index with the word spans that windows of the items
    cover (disjoint, ascending) and the ids of the items with a match."""
    if window > GAP:
        raise ValueError(f"a window may have {GAP} words at most")
    numbered = index.withColumn("segment", F.xxhash64("doc_ids", "n_words", "terms", "postings"))
    parts = [numbered.mapInArrow(_searcher(Phrases(block, window)), HITS_SCHEMA)
             for block in item_blocks(items, max_words=max_words)]
    if len(parts) == 1:
        return parts[0]
    # Several blocks: unite their spans per document.  Repeated identical
    # segments give identical rows; numbering them apart is left to ``ord``.
    numbered = store(index.withColumn("segment", F.monotonically_increasing_id()), "numbered-index")
    parts = [numbered.mapInArrow(_searcher(Phrases(block, window)), HITS_SCHEMA)
             for block in item_blocks(items, max_words=max_words)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    united = every.groupBy("segment", "ord", "doc_id", "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    start = F.struct(F.lit(-1).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("stop"))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def fold(acc, s):
        last = acc["last"]
        touches = s["start"] <= last["stop"]
        return F.struct(
            F.when(touches | (last["stop"] < 0), acc["done"]).otherwise(F.concat(acc["done"], F.array(last))).alias("done"),
            F.when(touches, F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop")))
            .otherwise(s).alias("last"))

    merged = F.aggregate("spans", F.struct(empty.alias("done"), start.alias("last")), fold, lambda a: F.when(
        a["last"]["stop"] < 0, a["done"]).otherwise(F.concat(a["done"], F.array(a["last"]))))
    return united.withColumn("spans", merged)


def proximity(index: DataFrame, queries: DataFrame, span: int, key: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_near): documents where all words of a query lie within
    ``span`` consecutive words; n_near counts the occurrences of its rarest word
    that take part."""
    if span > GAP:
        raise ValueError(f"a span may have {GAP} words at most")
    out = None
    for block in item_blocks(queries, key):
        wanted = [(name, np.unique(h)) for name, h in block if len(h)]

        def run(batches, wanted=wanted):
            schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("n_near", pa.int64())])
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = Segment({n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)})
                    rows: list = []
                    for name, terms in wanted:
                        doc, n = np.unique(segment.doc_of(segment.near(segment.ordinals(terms), span)), return_counts=True)
                        rows += [(segment.doc_ids[d], name, int(k)) for d, k in zip(doc, n, strict=True)]
                    cols = list(zip(*rows, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        part = index.mapInArrow(run, "doc_id bigint, item_id string, n_near bigint")
        out = part if out is None else out.unionByName(part)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items, contaminated for every document row."""
    found = search(build_index(docs), items, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, all columns kept.  Rows are told
    apart by a hash of id and text, so equal ids with other texts are judged apart."""
    # The document is one struct, so its columns can have any names.
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text", F.struct("*").alias("document"))
    judged = contamination(keyed.select(F.col("row").alias("doc_id"), "text"), items, window)
    bad = store(judged.where("contaminated").select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return keyed.select("row", "document").join(bad, "row", "left_anti").select("document.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents", "doc_id", "text")
    items = read_input(spark, sf_dir, "benchmark", "item_id", "text")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
