"""Near-duplicates and components against brute force."""

import collections
import random
from pathlib import Path

import llm_brute as B
import numpy as np
import pyarrow as pa
from conftest import SF0001
from pyspark.sql import functions as F

from eventrollup.llm import common, op3_neardup, op4_bpe
from eventrollup.llm.components import components


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, j) for j in range(1001, 1400)] + [(7, 7), (1001, 1000)]
    random.Random(3).shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert set(got) == {*range(0, 401), *range(1000, 1400)}
    assert all(c == (0 if n < 1000 else 1000) for n, c in got.items())
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_a_worker_drops_the_model_of_another_stage():
    op4_bpe.codec(op4_bpe.tokenizer_path())
    assert op4_bpe.codec(op4_bpe.tokenizer_path()) is op4_bpe.codec(op4_bpe.tokenizer_path())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b c d e"]})
    assert [b.num_rows for b in op3_neardup._signer(4)(iter([batch]))] == [1]
    assert not common._RESIDENT


def test_filter_and_step_run_in_one_process():
    sets = [np.arange(n, n + 9, dtype=np.uint64) << np.uint64(24) for n in range(60)]
    batch = pa.RecordBatch.from_pydict({"cls": list(range(60)), "set": [op3_neardup._pack(s) for s in sets]})
    bits = np.zeros(1 << (op3_neardup.FILTER_BITS - 6), dtype=np.uint64)
    for at in op3_neardup._places(np.array([3, 4], dtype=np.int64)):
        bits[at >> 6] |= np.uint64(1) << np.uint64(at & 63)
    out = list(op3_neardup._of_passing(op3_neardup._tokens, bits)(iter([batch])))
    got = dict(pair for b in out for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    assert got == {n: 1 + (3 < n < 12) for n in range(3, 13)}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    where, size = B.components(docs, 4)
    got = {r["doc_id"]: r for r in op3_neardup.op3_neardup(spark, SF0001).collect()}
    assert {i: (r["component_id"], r["n_shingles"], r["kept"]) for i, r in got.items()} == {
        i: (where[i], size[i], where[i] == i) for i, _ in docs}


def test_a_group_far_larger_than_a_leaf(spark):
    """Near copies of one text, each edited at its own places, beside unrelated ones."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(240)]
    docs = [(0, " ".join(base))]
    for i in range(1, 420):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(len(words))] = f"e{i}x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(f"u{rng.randrange(10**9)}" for _ in range(60))) for i in range(50)]
    where, _ = B.components(docs, 4)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in op3_neardup.near_duplicates(frame).collect()}
    assert got == where


def test_linked_pairs_inside_a_group_of_alike_members(spark):
    """Pages of one template, three quarters of each pair's words, of which only
    the planted pairs are linked."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(225)]
    docs = []
    for i in range(600):
        own = [f"o{i}x{j}" for j in range(32)]
        pair = [*own[:7], *(f"y{i}x{j}" for j in range(25))]
        docs += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + pair))]
    rng.shuffle(docs)
    where, _ = B.components(docs, 4)
    assert len(set(where.values())) == 600
    got = {r["doc_id"]: r["component_id"] for r in op3_neardup.near_duplicates(
        spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == where


def test_pairs_in_documents_that_share_a_long_passage(spark):
    """2,000 documents, 70 percent of each pair's shingles in the common passage:
    further splits part most pairs, their root splits do not."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(70)]
    docs = []
    for i in range(1000):
        own = [f"o{i}x{j}" for j in range(19)]
        docs += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:10] + [f"y{i}x{j}" for j in range(9)]))]
    rng.shuffle(docs)
    where, _ = B.components(docs, 4)
    assert len(set(where.values())) == 1000
    got = {r["doc_id"]: r["component_id"] for r in op3_neardup.near_duplicates(
        spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == where


def test_awkward_rows(spark):
    docs = B.awkward(spark)
    rows = op3_neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    # Copies in either case are one class; the smallest id stands for it.
    assert all(r["component_id"] == 8 for i in (8, 9, 10, 11) for r in by[i])
    assert by[6][0]["component_id"] == by[7][0]["component_id"] == 6 and not by[7][0]["kept"]
    assert all(by[i][0]["n_shingles"] == 0 and by[i][0]["kept"] for i in (1, 2, 3))
    assert by[4][0]["n_shingles"] == by[5][0]["n_shingles"] == 1 and by[4][0]["kept"] and by[5][0]["kept"]
    assert len(by[None]) == 3 and all(r["component_id"] is None for r in by[None])
    assert op3_neardup.near_duplicates(B.empty(spark)).collect() == []


def test_keep_first(spark):
    docs = B.awkward(spark)
    out = op3_neardup.keep_first(docs, 5)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 8, 12, 13, 14, 15]
    assert ids.count(None) == 2        # a text and a null, each once


def test_ids_with_two_texts_are_linked(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b)], "doc_id bigint, text string")
    assert {r["component_id"] for r in op3_neardup.near_duplicates(frame).collect()} == {1}
    assert frame.agg(F.count("*")).first()[0] == 4


def test_all_longs_are_ids(spark):
    """Ids up to the largest long, rows without an id among them, clashing columns kept."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    top = 2**63 - 1
    rows = [(top, base), (top - 5, base + " end"), (top - 6, "alone here with other words"), (-2**63, "far below zero it stands"),
            (None, base), (None, base), (None, "no id and no friend at all"), (2**62 + 2**61, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id bigint, text string, __id string")
    got = {(r["doc_id"], r["n_shingles"]): r for r in op3_neardup.near_duplicates(docs).collect()}
    assert all(r["component_id"] == top - 5 for (i, n), r in got.items() if n in (9, 10))
    assert sum(r["kept"] for r in op3_neardup.near_duplicates(docs).collect()) == 5
    for i in (top - 6, -2**63, 2**62 + 2**61):
        assert [r["component_id"] for (j, _), r in got.items() if j == i] == [i]
    kept = op3_neardup.keep_first(docs, 4, 80).collect()
    assert collections.Counter(r["doc_id"] for r in kept) == collections.Counter([top - 5, top - 6, -2**63, None, 2**62 + 2**61])
    assert {r["__id"] for r in kept} == {"mine"}


def test_scratch_tables_are_deleted_on_the_way(spark):
    """What a later step has replaced is gone before the result is read."""
    stored, real = {}, op3_neardup.store

    def noting(df, name, *args):
        out = real(df, name, *args)
        stored.setdefault(name, []).append(out)
        return out

    docs = [(i, " ".join(f"w{i // 2}x{j}" for j in range(60)) + f" tail{i % 2}") for i in range(40)]
    op3_neardup.store = noting
    try:
        got = op3_neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    finally:
        op3_neardup.store = real
    assert all(not Path(stored[name][0]._folder.removeprefix("file:")).exists()
               for name in ("signatures", "classes", "path-rows", "sets"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: i // 2 * 2 for i in range(40)}
