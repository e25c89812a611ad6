"""Personal data: base patterns and information-theoretic sanitisation.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; each
distinct value is a protected entity.  The words within ``WINDOW`` words of its
occurrences are its context.  Over the whole corpus,

    p(e)    share of all word places that lie in the entity's contexts
    p(e|t)  share of the occurrences of term t that lie there
    disclosure = log(p(e|t) / p(e)) / -log p(e)

that is, the pointwise mutual information of term and entity as a part of the
entity's information content: 0 if the term says nothing, 1 if it gives the
entity away.  Terms that occur with an entity in ``MIN_DOCS`` documents or more
and disclose more than ``MAX_DISCLOSURE`` of it are added as spans of kind
``term`` wherever they stand outside the base spans, in any document.  In sanitised texts, values are
replaced by the name of their kind, terms by ``[TERM]`` (words) or ``[NUMBER]``
(with a digit).

Term counts are taken over all words of all documents, summed inside each task
before anything is shuffled; only terms that reach the support are joined.  The
places of disclosing terms come from a second pass over the texts: a bit filter of
fixed size leaves out most other words, and a salted join is exact.

Defined results: null and empty texts have no spans (a null text stays null);
rows without an id are scanned like others; repeated rows give repeated rows; an
empty table gives no rows; columns other than the text are kept as they are,
except ``n_chars``, which follows the text.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm import words as W
from eventrollup.llm.common import read_input, ship, slices, store

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 10
WINDOW_CHARS = 400            # characters searched first for the words before a place
MIN_DOCS = 3
MAX_DISCLOSURE = 0.8
MIN_TERM = 3                  # shortest term, in characters
FILTER_BITS = 26              # 8 MB of bits
SALTS = 16                    # lots that the documents of one term are dealt into
HELD_TERMS = 2_000_000        # distinct terms that a counting task holds at once

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_DIGITS = re.compile("[0-9]+")

SCAN = ("key bigint, doc_id bigint, spans array<struct<kind:int,start:int,stop:int>>, "
        "contexts array<struct<entity:bigint,terms:array<struct<term:bigint,start:int,stop:int>>>>")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Without backtracking: a local part ends at its @ and holds none."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = floor + len(text[floor:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            floor = domain.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", floor)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of the base patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]
    return out


def _around(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """Spans of the ``WINDOW`` words before and after a place."""
    reach, before = WINDOW_CHARS, []
    while True:
        low = max(0, start - reach)
        before = [m.span() for m in _TERM.finditer(text, low, start)]
        # The first word may be cut by the edge of the search.
        if not low or len(before) > WINDOW:
            break
        reach *= 4
    after = [m.span() for m in islice(_TERM.finditer(text, stop), WINDOW)]
    return before[-WINDOW:] + after


def hashes(strings: list[str]) -> np.ndarray:
    """64-bit hashes of single words, as the corpus counts have them."""
    if not strings:
        return np.zeros(0, np.int64)
    data, offsets = W.text_bytes(pa.array(strings, pa.string()))
    return W.word_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    term = pa.struct([("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
    context = pa.struct([("entity", pa.int64()), ("terms", pa.list_(term))])
    for batch in slices(batches):
        spans, contexts = [], []
        for text in batch.column(2).to_pylist():
            found = base_spans(text) if text else []
            own = []
            if found:
                values = hashes([f"{k} {text[a:b].lower()}" for k, a, b in found])
                for (_, a, b), entity in zip(found, values.tolist(), strict=True):
                    near = [(x, y) for x, y in _around(text, a, b) if y - x >= MIN_TERM
                            and not any(x < q and p < y for _, p, q in found)]
                    terms = hashes([text[x:y] for x, y in near]).tolist()
                    own.append({"entity": entity, "terms": [
                        {"term": t, "start": x, "stop": y} for t, (x, y) in zip(terms, near, strict=True)]})
            spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
            contexts.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)), pa.array(contexts, pa.list_(context))],
            names=["key", "doc_id", "spans", "contexts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every word in the task's texts; the sum under term 0."""
    terms, counts, total = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        names, place = np.unique(np.concatenate(terms), return_inverse=True)
        return names, np.bincount(place, weights=np.concatenate(counts), minlength=len(names)).astype(np.int64)

    def out(names: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], names=["term", "n"])

    for batch in slices(batches):
        data, offsets = W.text_bytes(batch.column(0))
        starts, ends, _ = W.word_spans(data, offsets, W.ALPHANUMERIC)
        names, n = np.unique(W.word_hashes(data, starts, ends), return_counts=True)
        total += len(starts)
        terms.append(names)
        counts.append(n)
        if sum(map(len, terms)) > HELD_TERMS:
            names, n = merged()
            terms, counts = [names], [n]
            if len(names) > HELD_TERMS // 2:
                yield out(names, n)
                terms, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    yield out(*merged())
    yield out(np.zeros(1, np.uint64), np.array([total], dtype=np.int64))


def _bits(terms: np.ndarray) -> np.ndarray:
    return (W.mix(terms.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms -> non-zero words of the bit filter."""
    for batch in batches:
        at = np.unique(_bits(batch.column(0).to_numpy()))
        if len(at):
            word, first = np.unique(at >> 6, return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], names=["word", "mask"])


def _bit_filter(terms: DataFrame) -> np.ndarray:
    words = terms.mapInArrow(_filter_words, "word bigint, mask bigint") \
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy().view(np.uint64)
    return bits


def _finder(bits: np.ndarray):
    """Rows (key, text) -> (key, term, start, stop) of the words that pass the
    filter and touch no base span; places in characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = W.text_bytes(batch.column(1))
            starts, ends, _ = W.word_spans(data, offsets, W.ALPHANUMERIC)
            names = W.word_hashes(data, starts, ends).view(np.int64)
            at = _bits(names)
            hit = np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            # Characters before every byte: bytes that continue one are not counted.
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            row = np.searchsorted(offsets, starts[hit], side="right") - 1
            low, high = (chars[x[hit]] - chars[offsets[row]] for x in (starts, ends))
            free = np.ones(len(hit), dtype=bool)
            for i in np.unique(row).tolist():
                own = slice(*np.searchsorted(row, [i, i + 1]))
                for _, p, q in base_spans(batch.column(1)[i].as_py()):
                    free[own] &= (low[own] >= q) | (high[own] <= p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[free])), pa.array(names[hit][free]),
                 pa.array(low[free].astype(np.int32)), pa.array(high[free].astype(np.int32))],
                names=["key", "term", "start", "stop"])
    return run


def _places(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """(key, start, stop) of every occurrence of the flagged terms."""
    terms = store(flagged.select("term").distinct(), "pii-flagged")
    found = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text") \
        .mapInArrow(_finder(_bit_filter(terms)), "key bigint, term bigint, start int, stop int") \
        .withColumn("salt", F.pmod("key", F.lit(SALTS)))
    salted = terms.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return found.join(salted, ["term", "salt"], "left_semi").select("key", "start", "stop").distinct()


def _scanned(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return store(docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text").mapInArrow(_scan, SCAN), "pii-scan")


def disclosing_terms(docs: DataFrame, scanned: DataFrame, min_docs: int = MIN_DOCS,
                     max_disclosure: float = MAX_DISCLOSURE) -> DataFrame:
    """(entity, term, disclosure) of the pairs above the threshold."""
    seen = scanned.select("key", F.explode("contexts").alias("c")).select("key", "c.entity", "c.terms")
    width = store(seen.groupBy("entity").agg(F.sum(F.size("terms")).alias("width")), "pii-width")
    pairs = seen.select("key", "entity", F.explode("terms.term").alias("term"))
    together = store(pairs.groupBy("entity", "term", "key").agg(F.count(F.lit(1)).alias("n"))
                     .groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("docs"))
                     .where(F.col("docs") >= min_docs).select("entity", "term", "together"), "pii-together")
    wanted = store(together.select("term").unionByName(
        docs.sparkSession.createDataFrame([(0,)], "term bigint")).distinct(), "pii-wanted")
    counted = docs.select("text").mapInArrow(_count, "term bigint, n bigint")
    counts = store(counted.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n")), "pii-terms")
    total = counts.where("term = 0").agg(F.sum("n")).first()[0] or 0
    p = F.least(F.lit(1.0), F.col("width") / F.lit(float(max(total, 1))))
    given = F.least(F.lit(1.0), F.col("together") / F.col("n"))
    share = F.when(p < 1, F.log(given / p) / -F.log(p)).otherwise(0.0)
    out = together.join(counts, "term").join(width, "entity").withColumn("disclosure", share)
    return store(out.where(F.col("disclosure") > max_disclosure).select("entity", "term", "disclosure"), "pii-disclosing")


def find_personal(docs: DataFrame, min_docs: int = MIN_DOCS, max_disclosure: float = MAX_DISCLOSURE) -> DataFrame:
    """docs(doc_id, text) -> key (hash of id and text), doc_id, spans, terms: spans of
    the base patterns by kind, then start, and spans of disclosing terms by start."""
    scanned = _scanned(docs)
    flagged = disclosing_terms(docs, scanned, min_docs, max_disclosure)
    hit = _places(docs, flagged)
    terms = store(hit.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("terms")), "pii-places")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return scanned.select("key", "doc_id", "spans").join(terms, "key", "left") \
        .withColumn("terms", F.coalesce("terms", none))


def sanitise_text(text: str | None, terms: list[tuple[int, int]]) -> str | None:
    """Values become the name of their kind, terms a general one."""
    if not text:
        return text
    found = [(a, b, f"[{KINDS[k].upper()}]") for k, a, b in base_spans(text)]
    found += [(a, b, "[NUMBER]" if _DIGITS.search(text[a:b]) else "[TERM]") for a, b in terms]
    out, at = [], 0
    # Of overlapping spans the one that begins first, or the longer, gives the name.
    for a, b, name in sorted(found, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], name]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, min_docs: int = MIN_DOCS, max_disclosure: float = MAX_DISCLOSURE) -> DataFrame:
    """The documents with personal data and disclosing terms replaced in their texts."""
    columns = docs.columns
    found = find_personal(docs, min_docs, max_disclosure)
    terms = store(found.where(F.size("terms") > 0).select("key", "terms").dropDuplicates(["key"]), "pii-found")
    # The document is one struct, so its columns can have any names.
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.struct("*").alias("document")).join(terms, "key", "left")
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, columns[place]):
            texts = batch.column(place + 1)
            new = [sanitise_text(t, [(s["start"], s["stop"]) for s in spans or []])
                   for t, spans in zip(texts.to_pylist(), batch.column(0).to_pylist(), strict=True)]
            arrays = list(batch.columns[1:])
            arrays[place] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    spans = "terms"
    while spans.lower() in {c.lower() for c in columns}:
        spans += "_"
    out = keyed.select(F.col("terms").alias(spans), "document.*").mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(read_input(spark, sf_dir, "documents", "doc_id", "text"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def count(k):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")

    base = F.transform("spans", lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["stop"].cast("string")))
    return found.select("doc_id", count(0), count(1), count(2), count(3),
                        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"))
