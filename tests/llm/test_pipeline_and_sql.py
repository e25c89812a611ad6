"""The pipeline against plain versions of its stages, and the registered SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import llm_brute as B
import pytest
from conftest import SF001
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from eventrollup.llm import op4_bpe, op10_pii
from eventrollup.llm.registry import ORACLES, QUERIES


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "bpe"]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for p in Path(SF001).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df, rel = QUERIES[key](spark, SF001), con.sql(ORACLES[key])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    at = [rel.columns.index(c) for c in names]
    assert Counter(tuple(r[c] for c in names) for r in df.collect()) == Counter(
        tuple(r[i] for i in at) for r in rel.fetchall())


def _fixture(spark, folder):
    """A small table with every case, and items of a benchmark."""
    prose = "the old house by the river was sold to a man who came from far away and never spoke of it again "
    rows = [(i, f"{prose}and number{i} of the " + " ".join(f"n{i}w{j}" for j in range(40)), "en") for i in range(1, 40)]
    rows += [(i, " ".join(f"das haus nummer{i} und die{j} nicht mit der{i}" for j in range(12)), "de") for i in range(40, 70)]
    rows += [(70, "1234 5678 !!!", "en"), (71, rows[2][1], "en"), (72, rows[2][1] + " end", "en"), (73, None, "en"),
             (74, "write to max.muster@example.org or 192.168.1.77 about the old house by the river", "en"),
             (75, "item words one two three four five six seven eight nine ten eleven twelve", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    items = [(1, "words one two three four five six seven eight nine ten eleven twelve"), (2, "short item")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_pipeline_equals_plain_stages(spark, tmp_dir):
    rows, items = _fixture(spark, tmp_dir)
    got = {r["doc_id"]: r for r in P.run(spark, tmp_dir).collect()}
    known = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    where, _ = B.components(known, P.SHINGLE)
    first = [(i, t) for i, t in known if where[i] == i]
    bad = {r[0] for r in B.contamination(first, items) if r[-1]}
    clean = {i: op10_pii.sanitise_text(t, []) for i, t in first if i not in bad}
    assert set(got) == set(clean) and 75 not in got and 70 not in got and 71 not in got and 72 not in got
    library = Tokenizer.from_file(op4_bpe.tokenizer_path())
    for i, t in clean.items():
        assert got[i]["ids"] == library.encode(t, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(got[i]["ids"])
    assert "max.muster" not in clean[74] and "[EMAIL]" in clean[74] and "[IP]" in clean[74]


def test_pipeline_stages_keep_columns_and_empty_tables(spark, tmp_dir):
    _fixture(spark, tmp_dir)
    docs = B.awkward(spark)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, tmp_dir).columns == docs.columns, name
        assert stage(spark, B.empty(spark), tmp_dir).collect() == [], name
