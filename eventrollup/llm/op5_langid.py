"""Language identification with a blended-spectrum presence kernel.

A text is the set of its distinct character n-grams of lengths 1 to 4, lower-
cased and hashed into ``FEATURES`` bins (white space and digits act as word
ends).  The kernel of two texts is the cosine of their presence vectors.  The
Nystroem method replaces the kernel of all labelled texts by their kernel to
``LANDMARKS`` texts, and one-versus-rest kernel ridge regression is solved in
that space.  Texts are scored in batches by two matrix products: presence
vectors times landmarks, kernel values times coefficients.

Training uses text and language of documents whose crc32(doc_id as text) mod 5
is not 0.  The model is fitted on a bounded sample: ``SAMPLE`` rows of each
language, those with the lowest hash of their id.  What reaches the driver is
one bit vector per sampled row, whatever the size of the corpus.

``score`` is the share of the best language in a softmax over the regression
outputs (0 to 1).  Language, source and id are no inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing is labelled; rows without a language are not
learned; rows without an id count as id ``null``; repeated rows are scored
alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, ship, slices, store, vacate

FEATURES = 1 << 14
LANDMARKS = 192
SAMPLE = 600                  # rows per language that the model is fitted on
RIDGE = 1e-3
SHARPNESS = 6.0
UNKNOWN = "und"
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def presence(text: str) -> np.ndarray:
    """Feature vector (0 or 1) of one text, empty if it has no letter."""
    lower = text.lower()
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # Every character that is not a letter ends a word.
    kinds, where = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in kinds.tolist()], dtype=bool)
    if not letter.any():
        return np.zeros(0, dtype=np.uint8)
    codes = np.where(letter, kinds, 0).astype(np.uint32)[where]
    # Runs of word ends count as one.
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = np.concatenate([[0], codes[keep], [0]]).astype(np.uint32)
    out = np.zeros(FEATURES, dtype=np.uint8)
    value = np.zeros(len(codes), dtype=np.uint32)
    for n in range(4):
        if len(codes) <= n:
            break
        value = value[:len(codes) - n] * _MULT[0] + (codes[n:] + np.uint32(1)) * _MULT[1]
        mixed = (value ^ (value >> np.uint32(15))) * _MULT[2] + np.uint32(n) * _MULT[3]
        out[(mixed ^ (mixed >> np.uint32(13))) >> np.uint32(18)] = 1
    return out


class Model:
    """Landmarks, coefficients and language names."""

    def __init__(self, rows: np.ndarray, names: list[str], landmarks: int = LANDMARKS):
        """rows: presence vectors of the sample, names: their languages."""
        self.languages = sorted(set(names))
        rows = rows.astype(np.float32)
        rows /= np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
        # Landmarks: the first rows of each language in turn (sample order is random).
        rank: dict[str, int] = {}
        turn = []
        for i, name in enumerate(names):
            turn.append((rank.setdefault(name, 0), i))
            rank[name] += 1
        chosen = [i for _, i in sorted(turn)[:landmarks]]
        self.landmarks = np.ascontiguousarray(rows[chosen].T)
        kernel = (rows @ self.landmarks).astype(np.float64)
        target = np.where(np.array(names)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        # Balanced classes: every language weighs the same.
        weight = np.array([1.0 / rank[n] for n in names])[:, None]
        among = kernel[chosen]
        left = kernel.T @ (kernel * weight) + RIDGE * among + 1e-8 * np.eye(len(chosen))
        self.coefficients = np.linalg.lstsq(left, kernel.T @ (target * weight), rcond=None)[0].astype(np.float32)

    def score(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Best language and its share for a batch of presence vectors."""
        x = rows.astype(np.float32)
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        out = (x @ self.landmarks) @ self.coefficients
        share = np.exp(SHARPNESS * (out - out.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = out.argmax(axis=1)
        return [self.languages[i] for i in best], share[np.arange(len(best)), best].astype(np.float64)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [presence(t) for t in batch.column(1).to_pylist()]
        keep = [i for i, r in enumerate(rows) if len(r)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep, pa.int64())),
             pa.array([np.packbits(rows[i]).tobytes() for i in keep], pa.binary())], names=["lang", "bits"])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on docs(doc_id, text, lang); None if there is nothing to learn from.

    The sample of a language is bounded by a hash limit first (its expected
    number of rows is twice the sample) and cut on the few rows left, so no
    task sorts a whole language.
    """
    spark = docs.sparkSession
    ship(spark)
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Id and text: rows without an id are drawn one by one as well.
    learn = learn.withColumn("lot", F.xxhash64("doc_id", "text", F.lit(5)))
    sizes = store(learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-sizes")
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("n"))
    near = learn.join(sizes, "lang").where(
        F.shiftrightunsigned("lot", 11) < share * F.lit(float(1 << 53))).select("lang", "text", "lot")
    from pyspark.sql import Window

    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("lot", "text")))
    chosen = store(ranked.where(F.col("rank") <= sample).select("lang", "text"), "langid-sample")
    rows = chosen.mapInArrow(_vectors, "lang string, bits binary").orderBy(F.xxhash64("bits"), "lang").collect()
    if not rows:
        return None
    bits = np.frombuffer(b"".join(r["bits"] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
    return Model(np.unpackbits(bits, axis=1), [r["lang"] for r in rows])


def _judge(model: Model | None, texts: list) -> tuple[list[str], np.ndarray]:
    """Languages and scores of a list of texts, in batches of bounded size."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, scores
    at: list[int] = []
    rows: list[np.ndarray] = []
    for i, text in enumerate(texts):
        row = presence(text) if text else ()
        if len(row):
            at.append(i)
            rows.append(row)
        if rows and (len(rows) == 256 or i == len(texts) - 1):
            best, scores[at] = model.score(np.stack(rows))
            for k, name in zip(at, best, strict=True):
                names[k] = name
            at, rows = [], []
    return names, scores


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, lang_pred, score."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            names, scores = _judge(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents in a language that the model knows, with all their columns."""
    ship(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in slices(batches, max_bytes=1 << 20):
            names, _ = _judge(model, batch.column(place).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN for n in names]))

    return docs.mapInArrow(run, docs.schema)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = predict(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
