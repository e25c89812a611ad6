"""Secret scans with two character Markov models.

Base patterns find assignments, access keys and long hexadecimal runs.  Their
matches are the labelled samples of random strings; runs of identifier
characters in texts without a match are the samples of ordinary identifiers.
Both classes train a first-order character model (transition counts over the
whole corpus, add-one smoothing).  Every other run of identifier characters, from
``MIN_RUN`` = the shortest learned one on, is scored by the log-likelihood ratio of
the two models; runs that reach ``MIN_RATIO`` are added as spans of kind ``markov``.
The ratio itself guards short runs: it grows with every character.

The texts are read twice: one pass counts transitions, summed in Spark down to one
row per transition, the other scores all runs of a batch at once from the table.

Defined results: null and empty texts have no spans; rows without an id are
scanned like others; repeated rows give repeated rows; without any labelled
sample a model is uniform, and without samples of either kind nothing is added;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm import words as W
from eventrollup.llm.common import read_input, ship, slices

# Kinds in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run that is long enough is matched whole; shorter runs are dropped anyway.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_KEYS = re.compile(r"passw|secret|token|api", re.I | re.A)

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 8                   # shortest run that is learned and scored
MIN_RATIO = 12.0              # natural log of the likelihood ratio that makes a secret

_A = len(ALPHABET) + 1        # class 0: begin or end of a run
_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _c in enumerate(ALPHABET):
    _CLASS[ord(_c)] = _i + 1

def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, stop, kind) of the base patterns, by start, then kind."""
    out = []
    if _KEYS.search(text):
        out += [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(*m.span(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def _secret_values(text: str) -> list[str]:
    out = [m[2] for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [m[0] for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [m[0] for m in _HEX.finditer(text)]


def transitions(codes: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes in a sequence whose runs are parted by 0."""
    if len(codes) < 2:
        return np.zeros(_A * _A, dtype=np.int64)
    pair = codes[:-1].astype(np.int32) * _A + codes[1:]
    out = np.bincount(pair, minlength=_A * _A)
    out[0] = 0
    return out


def _runs(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = codes > 0
    cut = np.zeros(len(codes) + 1, dtype=bool)
    cut[offsets] = True
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    stops[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _read(batches: Iterator[pa.RecordBatch]):
    """Slices with their base spans, bytes, classes and runs (first, end, text)."""
    for batch in slices(batches):
        base = [base_spans(t) if t else [] for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        data, offsets = W.text_bytes(batch.column(batch.schema.get_field_index("text")))
        codes = _CLASS[data]
        starts, stops = _runs(codes, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        owner = np.searchsorted(offsets, starts, side="right") - 1
        long = np.flatnonzero(stops - starts >= MIN_RUN)
        yield batch, base, data, offsets, codes, starts[long], stops[long], owner[long]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> transition counts of ordinary identifiers and of labelled secrets."""
    for batch, base, _, _, codes, starts, stops, owner in _read(batches):
        counts = np.zeros((2, _A * _A), dtype=np.int64)
        # Ordinary identifiers: whole runs of texts without a base match.
        clean = np.array([not b for b in base])[owner] if len(owner) else np.zeros(0, bool)
        lens = (stops - starts)[clean]
        if len(lens):
            ends = np.cumsum(lens + 1)
            line = np.zeros(ends[-1] + 1, dtype=np.uint8)
            line[np.repeat(ends - lens, lens) + W.ramp(lens)] = codes[np.repeat(starts[clean], lens) + W.ramp(lens)]
            counts[0] = transitions(line)
        texts = batch.column(batch.schema.get_field_index("text"))
        values = [v for i, b in enumerate(base) if b for v in _secret_values(texts[i].as_py())]
        if values:
            line = _CLASS[np.frombuffer(("\n" + "\n".join(values) + "\n").encode(), dtype=np.uint8)]
            counts[1] = transitions(line)
        yield pa.RecordBatch.from_arrays([pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["counts"])


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * _A * _A, dtype=np.int64)
    for batch in batches:
        for body in batch.column(0).to_pylist():
            total += np.frombuffer(body, dtype="<i8")
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "n"])


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition, random over ordinary, from
    docs(text).  The driver receives one row per cell of the two tables at most.
    """
    ship(docs.sparkSession)
    cells = docs.select("text").mapInArrow(_counts, "counts binary") \
        .mapInArrow(_sum_counts, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(2 * _A * _A)
    for r in cells:
        total[r["cell"]] = r["n"]
    ordinary, random = (total.reshape(2, _A, _A) + 1.0)
    return np.log(random / random.sum(axis=1, keepdims=True)) - np.log(ordinary / ordinary.sum(axis=1, keepdims=True))


def ratio(table: np.ndarray, run: str) -> float:
    """Log-likelihood ratio of one run, its begin and end included."""
    codes = np.concatenate([[0], _CLASS[np.frombuffer(run.encode(), dtype=np.uint8)], [0]])
    return float(table[codes[:-1], codes[1:]].sum())


def _judge(table: np.ndarray, min_ratio: float):
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("ratio", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, base, data, offsets, codes, starts, stops, owner in _read(batches):
            spans = [[(a, k, b, None) for a, b, k in own] for own in base]
            if len(starts):
                inner = np.concatenate([[0.0], np.cumsum(table[codes[:-1], codes[1:]])])
                score = table[0, codes[starts]] + inner[stops - 1] - inner[starts] + table[codes[stops - 1], 0]
                # The sums differ in the last digits; the runs near the limit are judged one by one.
                near = np.flatnonzero(score >= min_ratio - 1e-6)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                low = chars[starts[near]] - chars[offsets[owner[near]]]
                for i, at in zip(near.tolist(), low.tolist(), strict=True):
                    a, b, own = int(starts[i]), int(stops[i]), owner[i]
                    exact = ratio(table, data[a:b].tobytes().decode())
                    if exact >= min_ratio and not any(at < y and x < at + b - a for x, y, _ in base[own]):
                        spans[own].append((at, 3, at + b - a, exact))
            out = [[{"start": a, "stop": b, "kind": KINDS[k], "ratio": s} for a, k, b, s in sorted(own, key=lambda x: x[:2])] for own in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], names=["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """docs(doc_id, text) -> doc_id, spans: by start, then kind; code points, end exclusive."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _judge(train(docs), min_ratio),
        "doc_id bigint, spans array<struct<start:int,stop:int,kind:string,ratio:double>>")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_input(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
