"""Exact BPE encoding by backtracking, and decoding by an offset table.

The vocabulary and merges of a public word-level BPE file are read on the
workers; nothing is trained.  A word becomes a string of units: its bytes, the
last one marked as the end of the word.  An Aho-Corasick automaton finds all
tokens inside the word and so the longest token at every place.  The encoder
takes the longest token that is compatible with the one before it, tries
shorter prefixes next, and steps back where none fits; places found to be dead
ends are marked, so every place is left at most once and the time is linear.

Two tokens are compatible if merging their joint text leaves exactly them.  That
is decided by undoing merges on both sides of the seam, from the latest merge
back, and looking for an earlier merge across the seam; verdicts are kept in a
table.  Tokens that merging never produces are left out of the automaton.

Special tokens in a text are ids of their own, as in the tokenizers library.
Normalising and splitting into words uses patterns here for texts of code points
up to U+00FF, and the library's own normaliser and splitter for all others.

Decoding joins the vocabulary strings of the ids with single blanks (the file
names no decoder), copied from one byte table by offsets.

Defined results: null and empty texts give no ids and an empty string; rows
without an id are encoded like others; repeated rows give repeated rows; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, resident, ship, slices
from eventrollup.llm.words import ramp

TOKENIZER = "word_bpe_49k.json"
END = "</w>"
CACHE_ENTRIES = 150_000
BATCH = 1 << 20

# Words of a lower-cased text of code points up to U+00FF.
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_MARK = 0x10000                      # a unit that ends a word


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return [out[b] for b in range(256)]


def _units(token: str) -> str:
    """Vocabulary string -> units, the end mark folded into the last one."""
    if token.endswith(END) and len(token) > len(END):
        token = token[:-len(END)]
        return token[:-1] + chr(ord(token[-1]) + _MARK)
    return token


class Table:
    """Byte strings by number, and the joined strings of a run of numbers."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.body[np.repeat(self.offset[ids], size) + ramp(size)]


class Merges:
    """Tokens numbered by merge order (base units first), with the tables of the encoder."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = {a + b for a, b in pairs}
        base = [t for t in vocab if t not in made]
        order = base + [a + b for a, b in pairs]
        number = {t: i for i, t in enumerate(order)}
        self.ids = [vocab[t] for t in order]
        self.text = [_units(t) for t in order]
        self.length = [len(t) for t in self.text]
        n = len(base)
        self.split = [(i, i) for i in range(n)] + [(number[a], number[b]) for a, b in pairs]
        self.merged = {p: n + r for r, p in reversed(list(enumerate(self.split[n:])))}
        self.verdict: dict[tuple[int, int], bool] = {}
        alive = [True] * len(order)
        for t in range(n, len(order)):
            a, b = self.split[t]
            alive[t] = alive[a] and alive[b] and self.merged[a, b] == t and self._apart(a, b, t)
        self.number = {self.text[t]: t for t in range(len(order)) if alive[t]}
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for s, t in self.number.items():
            self.automaton.add_word(s, t)
        self.automaton.make_automaton()
        self._prefix: dict[int, int] = {}

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge before ``limit`` joins something across the seam."""
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            # Undo the later of the two tokens' last merges; merges across the
            # seam then count only if they come before it.
            if left > right:
                side, whole = 1, left
            else:
                side, whole = 0, right
            if self.split[whole][0] == whole:           # a base unit: undo the other side
                side = 1 - side
                whole = left if side else right
                if self.split[whole][0] == whole:
                    return True
            if side:
                limit, left = left, self.split[left][1]
            else:
                limit, right = right + 1, self.split[right][0]

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.verdict.get(key)
        if known is None:
            if len(self.verdict) > CACHE_ENTRIES:
                self.verdict.clear()
            known = self.verdict[key] = self._apart(left, right, len(self.split))
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, -1 if none."""
        known = self._prefix.get(token)
        if known is None:
            s = self.text[token]
            known = next((self.number[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.number), -1)
            self._prefix[token] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Vocabulary ids of a word given in units."""
        whole = self.number.get(word)
        if whole is not None:
            return [self.ids[whole]]
        longest = [-1] * (len(word) + 1)
        for end, token in self.automaton.iter(word):
            start = end + 1 - self.length[token]
            if longest[start] < 0 or self.length[longest[start]] < self.length[token]:
                longest[start] = token
        live = [True] * (len(word) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(word):
            while token >= 0:
                if live[at + self.length[token]] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at += self.length[token]
                token = longest[at]
            else:
                if not out:
                    raise ValueError("a unit of the word is not in the vocabulary")
                live[at] = False
                token = out.pop()
                at -= self.length[token]
                # The same token again would end at the dead place.
                token = self.shorter(token)
        return [self.ids[t] for t in out]


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.merges = Merges(vocab, spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in self.special) + ")")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.byte = byte_characters()
        strings = {**vocab, **self.special}
        by_id = [b""] * (max(strings.values()) + 1)
        for s, i in strings.items():
            by_id[i] = s.encode()
        self.strings = Table([s + b" " for s in by_id])
        self.known: dict[str, bytes] = {}

    def _word(self, characters: str) -> bytes:
        ids = self.merges.encode(characters[:-1] + chr(ord(characters[-1]) + _MARK))
        return np.array(ids, dtype="<i4").tobytes()

    def _segment(self, text: str) -> bytes:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # Byte-level words, kept apart from plain ones by a leading blank.
            out = []
            for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text)):
                key = " " + w
                if key not in known:
                    known[key] = self._word(w)
                out.append(known[key])
            return b"".join(out)
        words = _WORDS.findall(text.lower())
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = self._word("".join([self.byte[b] for b in w.encode()]))
            return b"".join([known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if "<" not in text:
            return self._segment(text)
        parts = self.cut.split(text)
        return b"".join([np.array([self.special[p]], dtype="<i4").tobytes() if i % 2 else self._segment(p)
                         for i, p in enumerate(parts)])

    def decode(self, ids: np.ndarray) -> str:
        return self.strings.join(ids).tobytes()[:-1].decode()


def codec(path: str) -> Codec:
    """One codec per worker process, until it goes on to other work."""
    return resident(path, lambda: Codec(path))


def _coder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in slices(batches, max_bytes=BATCH):
            bodies = [c.encode(t or "") for t in batch.column(1).to_pylist()]
            ids = np.frombuffer(b"".join(bodies), dtype="<i4")
            ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in bodies])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                pa.array([c.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())],
                names=["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids array<int>, decoded string."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_coder(tokenizer), "doc_id bigint, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of coded documents."""
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents", "doc_id", "text")
    return digests(encode_decode(docs, tokenizer_path()))
