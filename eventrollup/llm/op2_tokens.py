"""Token files: a wavelet matrix per shard of documents.

Texts are encoded with a public byte-level tokenizer and every document ends
with ``END_ID``.  Documents are put in ascending order of id over all tasks and
cut into shards of bounded size (one longer document is one shard).  A shard stores its token sequence as a wavelet
matrix: one bit plane per bit of the largest id, highest first; below each
plane the sequence is split stably into the tokens with a 0 and those with a 1.
Per plane a directory of running counts of ones answers rank, and select
searches it, so one structure gives the token at a place, the number of times
a token occurs in a range, and the place of its j-th occurrence.

File format: ``shards``, Parquet files with one row per shard, so that Spark
writes them to any store and commits them whole: ``part`` (range of ids, in
order), ``before`` (ids of earlier shards of the part), ``doc_ids``, ``sizes``
(ids per document, little-endian 64-bit), ``n_tokens``, ``n_bits``, ``zeros``
(per plane) and ``planes`` (bits of all planes, each padded to whole 64-bit
words); and ``starts``, the ids before each part.  Rank directories are rebuilt
from the bits when a shard is read.

Defined results: a null or empty text is a document of the end id alone; rows
without an id come first; repeated rows are stored like others, rows with equal
ids side by side; an empty table writes no shard; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import partition_starts, read_input, ship, slices
from eventrollup.llm.op4_bpe import byte_characters
from eventrollup.llm.words import ramp
from eventrollup.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1 << 18
CACHE_ENTRIES = 600_000       # pieces remembered, besides those of a batch
LONG = 64                     # characters of the longest string remembered
WORDS, LOTS = 128, 64         # words in one text for the model, such texts in one call
BATCH = 8 << 20               # bytes of text encoded at once
PART = 1 << 18                # pieces whose ids are gathered at once

# One blank at most, then no white space at all.
_PLAIN = re.compile("[ ]?[^ \\n\\r\\t]+$")
# One word of the byte-level splitter, whatever stands beside it.
_WORD = re.compile("[ ]?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# White space other than blank, tab and line ends.
_OTHER_SPACES = "[\x0b\x0c\x1c-\x1f\x85\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
# Kinds of bytes.
_SIGN, _BREAK, _BLANK, _LETTER, _LATIN, _OTHER = range(6)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[:128] = _SIGN
_KIND[[9, 10, 13]] = _BREAK
_KIND[32] = _BLANK
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[0xc3] = _LATIN                  # leads U+00C0 .. U+00FF


def piece_starts(body: np.ndarray, rows: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where the pieces of some texts begin, in UTF-8: text i is body[rows[i]:rows[i + 1]],
    those of ``whole`` are not cut.

    Cuts that never part a token: before a run of plain white space that follows
    another character; behind a single tab or line end; and behind a run of letters
    that follows white space and ends at an ASCII sign.  Texts with any other white
    space have to be left whole.
    """
    kind = _KIND[body]
    space = (kind == _BREAK) | (kind == _BLANK)
    letter = kind == _LETTER
    lead = np.flatnonzero(kind == _LATIN)
    lead = lead[(body[lead + 1] != 0x97) & (body[lead + 1] != 0xb7)]
    letter[lead] = letter[lead + 1] = True
    edge = np.zeros(len(body) + 1, dtype=bool)
    edge[rows[:-1][np.diff(rows) > 0]] = True
    opens = space & (edge[:-1] | ~np.append(False, space[:-1]))
    first = opens | edge[:-1]
    first[1:] |= (opens & (kind == _BREAK))[:-1] & ~space[1:]
    # Runs of letters, parted at the beginnings of texts.
    run = np.flatnonzero(letter & (edge[:-1] | ~np.append(False, letter[:-1])))
    end = np.flatnonzero(letter & (edge[1:] | ~np.append(letter[1:], False))) + 1
    end = end[(first[run] | space[run - 1]) & (end < len(body))]
    first[end[kind[end] == _SIGN]] = True
    for i in whole.tolist():
        first[rows[i] + 1:rows[i + 1]] = False
    return np.flatnonzero(first)


class Encoder:
    """The tokenizer with a bounded memory of pieces it has encoded.

    The pieces of a batch of texts are numbered in one pass by Arrow; only different
    ones are looked up, all at once, and the ids of the texts are gathered by number.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.model = Tokenizer(self.tokenizer.model)          # neither splitter nor added tokens
        self.parting = self._parting()
        self.shown = np.array([ord(c) for c in byte_characters()], dtype="<u2")
        # The memory: pieces, their ids one after the other, ids of each, and whether
        # it was met again.
        self.known = pa.array([], pa.large_string())
        self.ids, self.sizes = np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        self.met = np.empty(0, dtype=bool)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parting(self) -> int | None:
        """Id of the zero byte if words can go to the model itself: split byte by
        byte without changes, and no merge takes that byte."""
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        split, model, zero = self.tokenizer.pre_tokenizer, self.tokenizer.model, byte_characters()[0]
        if self.tokenizer.normalizer is not None or not isinstance(split, ByteLevel) or not isinstance(model, BPE):
            return None
        if split.add_prefix_space or not split.use_regex or model.dropout or model.continuing_subword_prefix \
                or model.end_of_word_suffix:
            return None
        # An added token that could stand inside a word is cut out first by the library.
        if any(_WORD.fullmatch(f"{t.content}a") for t in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        vocab = self.tokenizer.get_vocab()
        return vocab.get(zero) if sum(zero in t for t in vocab) == 1 else None

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Words encoded by the model alone, some in one call with zero bytes between
        them: nothing is merged across one."""
        out = []
        for at in range(0, len(words), LOTS * WORDS):
            lots = []
            for i in range(at, min(at + LOTS * WORDS, len(words)), WORDS):
                units = np.frombuffer("\0".join([*words[i:i + WORDS], ""]).encode(), dtype=np.uint8)
                lots.append(self.shown[units].tobytes().decode("utf-16-le"))
            ids = [i for e in self.model.encode_batch_fast(lots, add_special_tokens=False) for i in e.ids]
            out += self._parts(np.array(ids[:-1], dtype="<u4"), self.parting)
        return out

    @staticmethod
    def _parts(ids: np.ndarray, end: int) -> list[bytes]:
        """The runs of ids between those that equal ``end``."""
        ends = np.append(np.flatnonzero(ids == end), len(ids)) * 4
        starts = np.append(0, ends[:-1] + 4)
        body = ids.tobytes()
        return [body[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _encode_lines(self, pieces: list[str]) -> list[bytes]:
        """Plain pieces encoded in one call, as the lines of a text: a line end
        between them is a token of its own, found nowhere else."""
        ids = np.array(self.tokenizer.encode("\n".join(pieces), add_special_tokens=False).ids, dtype="<u4")
        return self._parts(ids, self.line_end)

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        words = [p for p in pieces if _WORD.fullmatch(p)] if self.parting is not None else []
        got = dict(zip(words, self._encode_words(words), strict=True))
        rest = [p for p in pieces if p not in got]
        plain = [p for p in rest if _PLAIN.match(p)]
        for at in range(0, len(plain), 2_000):
            part = plain[at:at + 2_000]
            got.update(zip(part, self._encode_lines(part), strict=True))
        other = [p for p in rest if p not in got]
        got.update(zip(other, self._encode(other), strict=True))
        return got

    def _forget(self) -> None:
        """Pieces that were met again stay, half the memory at most."""
        stay = np.flatnonzero(self.met)[:CACHE_ENTRIES // 2]
        begin, n = (np.cumsum(self.sizes) - self.sizes)[stay], self.sizes[stay]
        self.known = self.known.take(pa.array(stay))
        self.ids, self.sizes = self.ids[np.repeat(begin, n) + ramp(n)], n
        self.met = np.zeros(len(stay), dtype=bool)

    def _look_up(self, pieces: pa.Array, whole: set[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of some pieces, and where those of each of the different ``pieces`` begin
        and how many it has; ``whole``: texts that were not cut."""
        if len(self.known) > CACHE_ENTRIES:
            self._forget()
        place = pc.index_in(pieces, value_set=self.known)
        unmet = place.is_null()
        new = pieces.filter(unmet)
        strings = new.to_numpy(zero_copy_only=False).tolist()
        texts = [p for p in strings if p in whole]
        got = self._encode_pieces([p for p in strings if p not in whole] if whole else strings)
        got.update(zip(texts, self._encode(texts), strict=True))
        add = [got[p] for p in strings]
        size = np.fromiter(map(len, add), dtype=np.int64, count=len(add)) // 4
        # The new ones stand behind those of the memory.
        n = len(self.known)
        at = place.fill_null(-1).to_numpy().astype(np.int64)
        self.met[at[at >= 0]] = True
        at[at < 0] = n + np.arange(len(new))
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(add), dtype="<u4")])
        sizes = np.concatenate([self.sizes, size])
        begin = np.cumsum(sizes) - sizes
        # Long pieces hardly come again and would fill the memory.
        short = pc.less_equal(pc.utf8_length(new), LONG).to_numpy(zero_copy_only=False)
        if whole:
            short &= np.array([p not in whole for p in strings], dtype=bool)
        self.known = pa.concat_arrays([self.known, new.filter(pa.array(short))])
        self.ids = ids if short.all() else np.concatenate([self.ids, ids[len(self.ids):][np.repeat(short, size)]])
        self.sizes = np.concatenate([self.sizes, size[short]])
        self.met = np.concatenate([self.met, np.zeros(int(short.sum()), dtype=bool)])
        return ids, begin[at], sizes[at]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has (null: none)."""
        if not pc.sum(pc.binary_length(texts)).as_py():
            return np.empty(0, dtype="<u4"), np.zeros(len(texts), dtype=np.int64)
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        rows = np.frombuffer(offsets, dtype="<i8")[texts.offset:texts.offset + len(texts) + 1]
        body = np.frombuffer(data, dtype=np.uint8)[rows[0]:rows[-1]]
        rows = rows - rows[0]
        spaced = pc.match_substring_regex(texts, _OTHER_SPACES)
        starts = piece_starts(body, rows, pc.indices_nonzero(spaced).to_numpy())
        offsets = np.append(starts, len(body)).astype("<i8")
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(body)).dictionary_encode()
        known, begin, size = self._look_up(pieces.dictionary, set(texts.filter(spaced).to_pylist()))
        number = pieces.indices.to_numpy()
        n = size[number]
        # A part of the pieces at a time: places take more memory than ids.
        tokens = np.concatenate([known[np.repeat(begin[number[at:at + PART]], n[at:at + PART]) + ramp(n[at:at + PART])]
                                 for at in range(0, len(number), PART)])
        ends = np.append(0, np.cumsum(n))
        return tokens, np.diff(ends[np.searchsorted(starts, rows)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        tokens, sizes = self.encode_column(pa.array(texts, pa.large_string()))
        ends = np.cumsum(sizes)
        return [tokens[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- wavelet matrix ------------------------------------------------------------

class WaveletMatrix:
    """Rank and select over a sequence of non-negative integers."""

    def __init__(self, n: int, n_bits: int, zeros: np.ndarray, planes: np.ndarray):
        self.n, self.n_bits, self.zeros = n, n_bits, zeros
        self.planes = planes                       # (n_bits, bytes per plane), bits little-endian
        self._ones: list[np.ndarray] | None = None

    @staticmethod
    def build(tokens: np.ndarray) -> WaveletMatrix:
        n = len(tokens)
        n_bits = max(1, int(tokens.max()).bit_length()) if n else 1
        now = tokens.astype(np.uint16 if n_bits <= 16 else np.uint32)
        zeros = np.zeros(n_bits, dtype="<i8")
        planes = np.zeros((n_bits, (n + 63) // 64 * 8), dtype=np.uint8)
        for level in range(n_bits):
            bit = now & now.dtype.type(1 << (n_bits - 1 - level)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[level, :len(packed)] = packed
            low = np.compress(~bit, now)
            zeros[level] = len(low)
            now = np.concatenate([low, np.compress(bit, now)])
        return WaveletMatrix(n, n_bits, zeros, planes)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n, bitorder="little")

    def _rank(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before place i of a plane: words before it, then bits of its word."""
        if self._ones is None:
            words = self.planes.reshape(self.n_bits, -1, 8).copy().view("<u8")[:, :, 0]
            counts = np.bitwise_count(words).astype(np.int64)
            self._words = words
            self._ones = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        inside = np.zeros(len(i), dtype=np.int64)
        part = bit > 0
        mask = (np.uint64(1) << bit[part]) - np.uint64(1)
        inside[part] = np.bitwise_count(self._words[level][word[part]] & mask)
        return self._ones[level][word] + inside

    def access(self, places: np.ndarray) -> np.ndarray:
        """Tokens at some places."""
        i = np.asarray(places, dtype=np.int64)
        out = np.zeros(len(i), dtype=np.int64)
        for level in range(self.n_bits):
            ones = self._rank(level, i)
            bit = self._rank(level, i + 1) - ones
            out = (out << 1) | bit
            i = np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return out

    def _descend(self, token: int, place: int) -> int:
        """Where place ``place`` of the sequence falls among the copies of ``token``
        at the bottom level."""
        i = np.array([place], dtype=np.int64)
        for level in range(self.n_bits):
            ones = self._rank(level, i)
            i = self.zeros[level] + ones if (token >> (self.n_bits - 1 - level)) & 1 else i - ones
        return int(i[0])

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often ``token`` occurs at places start .. stop - 1."""
        if token < 0 or token >> self.n_bits or not self.n:
            return 0
        return self._descend(token, self.n if stop is None else stop) - self._descend(token, start)

    def select(self, token: int, j: int) -> int:
        """Place of occurrence j (from 0) of ``token``, -1 if there are fewer."""
        if j < 0 or j >= self.count(token):
            return -1
        i = self._descend(token, 0) + j
        for level in range(self.n_bits - 1, -1, -1):
            if (token >> (self.n_bits - 1 - level)) & 1:
                want, ones = i - int(self.zeros[level]), True
            else:
                want, ones = i, False
            low, high = 0, self.n - 1                # the last place with that rank before it
            while low < high:
                mid = (low + high) // 2
                r = int(self._rank(level, np.array([mid + 1]))[0])
                if (r if ones else mid + 1 - r) > want:
                    high = mid
                else:
                    low = mid + 1
            i = low
        return i

    def tokens(self) -> np.ndarray:
        """The whole sequence, rebuilt from the lowest plane up."""
        now = np.zeros(self.n, dtype=np.uint16 if self.n_bits <= 16 else np.uint32)
        for level in range(self.n_bits - 1, -1, -1):
            bit = self._bits(level).view(bool)
            now[self.zeros[level]:] |= now.dtype.type(1 << (self.n_bits - 1 - level))
            up = np.empty_like(now)
            up[np.concatenate([np.flatnonzero(~bit), np.flatnonzero(bit)])] = now
            now = up
        return now


SHARD_SCHEMA = ("part int, before bigint, doc_ids array<bigint>, sizes binary, n_tokens bigint, n_bits int, "
                "zeros binary, planes binary")


def _shard_batches(path: str, end_id: int, max_tokens: int):
    """Texts in ascending order of id within a partition -> its shards, one row each."""
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("sizes", pa.binary()), ("n_tokens", pa.int64()), ("n_bits", pa.int32()),
                        ("zeros", pa.binary()), ("planes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before, held = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        tokens: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        enc = encoder(path)

        def done():
            w = WaveletMatrix.build(np.concatenate(tokens))
            return pa.RecordBatch.from_pylist([{
                "part": part, "before": before, "doc_ids": ids,
                "sizes": np.concatenate(sizes).astype("<i8").tobytes(), "n_tokens": w.n,
                "n_bits": w.n_bits, "zeros": w.zeros.tobytes(), "planes": w.planes.tobytes()}], schema=schema)

        for batch in slices(batches, max_bytes=BATCH):
            new, size = enc.encode_column(batch.column(1))
            new = np.insert(new, np.cumsum(size), end_id)
            size = size + 1
            ends = np.cumsum(size)
            at = base = 0
            while at < batch.num_rows:
                # Up to the document that fills the shard.
                to = min(int(np.searchsorted(ends, base + max_tokens - held)) + 1, batch.num_rows)
                ids += batch.column(0).slice(at, to - at).to_pylist()
                tokens.append(new[base:ends[to - 1]])
                sizes.append(size[at:to])
                held += int(ends[to - 1]) - base
                at, base = to, int(ends[to - 1])
                if held >= max_tokens:
                    yield done()
                    ids, tokens, sizes, before, held = [], [], [], before + held, 0
        if ids:
            yield done()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode docs(doc_id, text) and write the shards under ``path``, ascending by id.

    The texts are dealt by ranges of ids and sorted inside them, then encoded
    where they arrive: the ids of the tokens are never shuffled, and a text is
    encoded once.  ``starts`` has one row per range: the ids before it.
    """
    spark = docs.sparkSession
    ship(spark)
    order = ["doc_id", "tie"]
    # Rows with equal ids are ordered by their text, so that a repeated task deals alike.
    dealt = docs.select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("tie")) \
        .repartitionByRange(*order).sortWithinPartitions(*order, "text")
    dealt.select("doc_id", "text").mapInArrow(_shard_batches(tokenizer, end_id, shard_tokens), SHARD_SCHEMA) \
        .write.option("compression", "zstd").parquet(f"{path}/shards")
    counts = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards") \
        .groupBy(F.col("part").alias("__part")).agg(F.sum("n_tokens").alias("__n"))
    partition_starts(counts).select(F.col("__part").alias("part"), F.col("__start").alias("start")) \
        .write.parquet(f"{path}/starts")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the ids of all documents before each."""
    starts = spark.read.schema("part int, start bigint").parquet(f"{path}/starts")
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{path}/shards")
    return shards.join(F.broadcast(starts), "part") \
        .withColumn("start", F.col("start") + F.col("before")).drop("before")


def open_shard(row) -> WaveletMatrix:
    """The wavelet matrix of one shard row (a mapping of its columns)."""
    planes = np.frombuffer(row["planes"], dtype=np.uint8).reshape(row["n_bits"], -1)
    return WaveletMatrix(row["n_tokens"], row["n_bits"], np.frombuffer(row["zeros"], dtype="<i8"), planes)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                tokens = open_shard(row).tokens().astype("<u4")
                sizes = np.frombuffer(row["sizes"], dtype="<i8")
                ends = np.cumsum(sizes)
                begin = ends - sizes
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(begin + row["start"]), pa.array(sizes),
                    pa.array([zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(begin, ends, strict=True)], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = read_shards(spark, path).select("start", "doc_ids", "sizes", "n_tokens", "n_bits", "zeros", "planes")
    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(shard start, count, first, last) of a token in every shard that has it;
    first and last are places in the whole sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                w = open_shard(row)
                n = w.count(token)
                if n:
                    yield pa.RecordBatch.from_pydict({
                        "start": [row["start"]], "count": [n], "first": [row["start"] + w.select(token, 0)],
                        "last": [row["start"] + w.select(token, n - 1)]})

    return read_shards(spark, path).select("start", "n_tokens", "n_bits", "zeros", "planes") \
        .mapInArrow(run, "start bigint, count bigint, first bigint, last bigint")


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    write_tokens(read_input(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer_path(TOKENIZER))
    return read_documents(spark, path)
