"""Token files and BPE: the tokenizers library is the measure."""

import random
import re
import zlib

import llm_brute as B
import numpy as np
from conftest import SF0001
from tokenizers import Tokenizer

from eventrollup.llm import op2_tokens, op4_bpe
from eventrollup.session import work_dir

PIECES = ["a", "b", "th", "ing", " ", "  ", "\n", "\r\n", "\t", "'s", "'LL", "É", "é", "ß", "<|endoftext|>", "12", "\xa0",
          "\x85", "\x1c", "\x0b", " ", "　", "中", "#", "!!", "²", "Σ", "İ", "́", "<|", "|>", " the", "😀", "K", "."]


def _texts(n, k):
    rng = random.Random(n)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, k))) for _ in range(n)]


def test_piecewise_encoding_equals_the_library():
    path = op2_tokens.tokenizer_path(op2_tokens.TOKENIZER)
    library, own = Tokenizer.from_file(path), op2_tokens.Encoder(path)
    texts = _texts(4000, 24)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == want


def test_words_go_to_the_model_alone(monkeypatch):
    """New words cost neither the splitter nor the offsets of the whole tokenizer."""
    path = op2_tokens.tokenizer_path(op2_tokens.TOKENIZER)
    library, own = Tokenizer.from_file(path), op2_tokens.Encoder(path)
    monkeypatch.setattr(own, "_encode", lambda texts: [1 // 0 for _ in texts])
    monkeypatch.setattr(own, "_encode_lines", lambda pieces: [1 // 0 for _ in pieces])
    texts = ["", "the thonrewh étété ÿß", " leading words", "x" * 400 + " y"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == want


def test_encoding_while_the_memory_is_forgotten(monkeypatch):
    monkeypatch.setattr(op2_tokens, "CACHE_ENTRIES", 40)
    path = op2_tokens.tokenizer_path(op2_tokens.TOKENIZER)
    library, own = Tokenizer.from_file(path), op2_tokens.Encoder(path)
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["the", "a", "word,", "x  y", "", "é.", "b\nc", "q\n", "zwh"], k=rng.randint(0, 30)))
             + str(i) for i in range(400)]
    for at in range(0, 400, 20):
        part = texts[at:at + 20]
        want = [library.encode(t, add_special_tokens=False).ids for t in part]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(part)] == want


def test_wavelet_matrix_against_the_plain_sequence():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (63, 2), (64, 5), (65, 70_000), (5000, 300)):
        x = rng.integers(0, top, n)
        w = op2_tokens.WaveletMatrix.build(x)
        assert (w.tokens() == x).all() and (w.access(np.arange(n)) == x).all()
        for t in {0, 1, top - 1, top, 80_000}:
            places = np.flatnonzero(x == t)
            assert w.count(t) == len(places) and w.select(t, len(places)) == -1
            assert [w.select(t, j) for j in range(len(places))] == places.tolist()
            assert w.count(t, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()


def _expected(rows):
    library = Tokenizer.from_file(op2_tokens.tokenizer_path(op2_tokens.TOKENIZER))
    out, at = [], 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [op2_tokens.END_ID]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_round_trip(spark):
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in op2_tokens.op2_tokens(spark, SF0001).collect())
    assert got == _expected(rows)


def test_token_files_awkward_rows(spark):
    docs = B.awkward(spark)
    path = work_dir(spark, "tokens")
    op2_tokens.write_tokens(docs, path, op2_tokens.tokenizer_path(op2_tokens.TOKENIZER), shard_tokens=1000)
    got = sorted((tuple(r) for r in op2_tokens.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] is None for r in got] == sorted((r[0] is None for r in got), reverse=True)
    ids = [r[0] for r in got if r[0] is not None]
    assert ids == sorted(ids)
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    want = sorted((str(r[0]), r[2], r[3]) for r in _expected([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == want
    ends = op2_tokens.occurrences(spark, path, op2_tokens.END_ID).collect()
    assert sum(r["count"] for r in ends) >= docs.count()
    assert max(r["last"] for r in ends) == sum(r[2] for r in got) - 1


def _plain_cuts(text):
    """Where pieces begin, character by character."""
    space, letter = " \t\r\n", re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]")
    cuts, core = {0} if text else set(), 0
    for i in range(1, len(text)):
        if text[i] in space and text[i - 1] not in space:
            cuts.add(i)
        if text[i] not in space and text[i - 1] in space:
            core = i
            if text[i - 1] != " " and (i == 1 or text[i - 2] not in space):
                cuts.add(i)
        sign = ord(text[i]) < 128 and text[i] not in space and not letter.match(text[i])
        if sign and core < i and all(map(letter.match, text[core:i])):
            cuts.add(i)
    return sorted(cuts)


def test_pieces_are_cut_text_by_text():
    rng = random.Random(4)
    alphabet = ["a", "B", "É", "×", "÷", "ÿ", "中", ".", "1", " ", " ", "\n", "\t", "\r", "'"]
    texts = ["".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 5, 12]))) for _ in range(3000)]
    rows = np.cumsum([0] + [len(t.encode()) for t in texts])
    whole = np.arange(0, 3000, 50)
    body = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    want = [r + len(t[:c].encode()) for i, (r, t) in enumerate(zip(rows.tolist(), texts, strict=False))
            for c in (_plain_cuts(t)[:1] if i % 50 == 0 else _plain_cuts(t))]
    assert op2_tokens.piece_starts(body, rows, whole).tolist() == want


def test_each_different_piece_is_looked_up_once(monkeypatch):
    path = op2_tokens.tokenizer_path(op2_tokens.TOKENIZER)
    library, own = Tokenizer.from_file(path), op2_tokens.Encoder(path)
    seen, look_up = [], own._look_up
    monkeypatch.setattr(own, "_look_up", lambda pieces, whole: seen.extend(pieces.to_pylist()) or look_up(pieces, whole))
    texts = ["the cat, the dog.\nThe cat", "", "1" * 500] * 300
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == want
    assert sorted(seen) == sorted(["the", " cat", ",", " the", " dog", ".", "\n", "The", "1" * 500])
    known = own.known.to_pylist()
    assert "1" * 500 not in known and " cat" in known and len(known) == len(own.sizes) == len(own.met)


def test_a_shard_ends_with_the_document_that_fills_it(spark):
    path = work_dir(spark, "tokens")
    docs = spark.createDataFrame([(i, "a b c d e f g h i" if i % 7 else None) for i in range(200)], "doc_id long, text string")
    op2_tokens.write_tokens(docs.coalesce(1), path, op2_tokens.tokenizer_path(op2_tokens.TOKENIZER), shard_tokens=40)
    shards = op2_tokens.read_shards(spark, path).collect()
    sizes = [np.frombuffer(r["sizes"], "<i8") for r in shards]
    assert all(x[:-1].sum() < 40 and x.sum() == r["n_tokens"] for x, r in zip(sizes, shards, strict=True))
    got = sorted((tuple(r) for r in op2_tokens.read_documents(spark, path).collect()))
    assert got == _expected([(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()])


def test_token_files_empty(spark):
    path = work_dir(spark, "tokens")
    op2_tokens.write_tokens(B.empty(spark), path, op2_tokens.tokenizer_path(op2_tokens.TOKENIZER))
    assert op2_tokens.read_documents(spark, path).collect() == []


def test_backtracking_equals_the_library():
    path = op4_bpe.tokenizer_path()
    library, own = Tokenizer.from_file(path), op4_bpe.Codec(path)
    rng = random.Random(9)
    texts = _texts(3000, 20) + ["".join(rng.choices("aeinstrhl", k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.randint(0, 0x2FF)) for _ in range(30)) for _ in range(1000)] + ["a" * 20_000, "ab" * 9_999]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        ids = np.frombuffer(own.encode(t), "<i4")
        assert ids.tolist() == want, t[:80]
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def _digests(rows):
    library = Tokenizer.from_file(op4_bpe.tokenizer_path())
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        out.append((str(i), len(ids), B.sha(" ".join(map(str, ids))), B.sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out)


def test_bpe_query_and_awkward_rows(spark):
    given = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    got = op4_bpe.op4_bpe(spark, SF0001).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == _digests(given)
    docs = B.awkward(spark)
    got = op4_bpe.digests(op4_bpe.encode_decode(docs, op4_bpe.tokenizer_path())).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == _digests([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert op4_bpe.encode_decode(B.empty(spark), op4_bpe.tokenizer_path()).collect() == []
