"""Conversation repair, fill-in-middle and SimHash against plain versions."""

import collections
import functools
import hashlib
import itertools
import random
import re

import llm_brute as B
import numpy as np
import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F

from eventrollup.llm import op11_repair, op12_fim, op13_simhash

# --- op11 -------------------------------------------------------------------------

CONV = "conv_id bigint, turn bigint, role string, text string, chunk int, code string, state string, position int, same int"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(op11_repair.SPACES)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, letters, messages) by trying every edit at every row."""
    kinds = faults(rows)
    made = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @functools.lru_cache(maxsize=None)
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            c, l, m = best(i, made[state], inserted + 1)
            found.append((c + 2, "I" + l, (f"{name[made[state]]}:", *m)))
        if i < len(rows):
            role, text = rows[i]
            c, l, m = best(i + 1, state, 0)
            found.append((c + 3, "D" + l, m))
            if kinds[i] in ("", "truncated"):
                extra, first = int(kinds[i] == "truncated"), role[:1]
                if (first, state) in {("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")}:
                    c, l, m = best(i + 1, first, 0)
                    found.append((c + extra, "K" + l, (f"{role}:{text}", *m)))
                c, l, m = best(i + 1, made[state], 0)
                found.append((c + extra + 2, "R" + l, (f"{name[made[state]]}:{text}", *m)))
        return min(found, default=(10**6, "", ()))

    return best(0, "", 0)


def _random_rows(rng, n):
    role = lambda: rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""])
    text = lambda: rng.choice(["a.", "b!", "c", "d?", " ", "", "e. ", "f.\nx", "g" + str(rng.random())])
    return [(role(), text()) for _ in range(n)]


def test_tables_equal_plain_costs_and_letters():
    rng = random.Random(5)
    t = op11_repair.tables()
    for n in [0, 1, 2, 3, 4, 5, 7, 8, 9, 13] * 30:
        rows = _random_rows(rng, n)
        symbols = np.array([8 if f in ("blank", "duplicate") else 4 * (f == "truncated") + ("sua".index(r[:1]) if r[:1] and r[:1] in "sua" else 3)
                            for (r, _), f in zip(rows, faults(rows), strict=True)], np.int64)
        left, paid, _ = t.back(symbols, t.end)
        edits, q = t.trace(symbols, t.end, op11_repair.START)
        cost, letters, _ = plain_repair(rows)
        assert paid + t.vectors[left][op11_repair.START] == cost
        assert "".join(edits) + op11_repair._TAIL[q] == letters


def _repaired(spark, rows, chunk=op11_repair.CHUNK):
    edits, report = op11_repair.repair(rows, chunk)
    kept = collections.defaultdict(list)
    for r in edits.orderBy("conv_id", "chunk", "step").collect():
        kept[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
    return kept, {r["conv_id"]: r for r in report.collect()}


def test_repair_equals_plain_version(spark):
    rng = random.Random(7)
    convs = {i: _random_rows(rng, rng.randint(1, 14)) for i in range(60)}
    convs[None] = _random_rows(rng, 5)
    rows = [(c, k if k % 5 else None, r, t, 1, "x", "y", 2, 3) for c, v in convs.items() for k, (r, t) in enumerate(v)]
    # Null turns come first.
    order = {c: sorted(range(len(v)), key=lambda k: (k % 5 != 0, k, v[k][0])) for c, v in convs.items()}
    nulls = {c: [k for k in o if k % 5 == 0] for c, o in order.items()}
    for c, v in convs.items():
        first = sorted(nulls[c], key=lambda k: (v[k][0], hashlib.md5(v[k][1].encode()).hexdigest()))
        order[c] = first + [k for k in order[c] if k % 5]
    kept, report = _repaired(spark, spark.createDataFrame(rows, CONV), chunk=5)
    for c, v in convs.items():
        ordered = [v[k] for k in order[c]]
        cost, letters, messages = plain_repair(ordered)
        n = collections.Counter(faults(ordered))
        turns = [k for k in range(len(v)) if k % 5]
        assert (report[c]["cost"], report[c]["audit"]) == (cost, letters)
        assert [f"{r}:{t}" for e, r, t in kept[c] if e != "D"] == list(messages)
        assert "".join(e for e, _, _ in kept[c]) == letters
        assert [report[c][x] for x in ("blank", "duplicate", "truncated")] == [n["blank"], n["duplicate"], n["truncated"]]
        assert report[c]["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert report[c]["illegal"] == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(ordered))


def test_repair_long_conversation_in_chunks(spark):
    rows = spark.range(30_000).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 7 == 0, "system").when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 11 == 0, "same.").otherwise(F.concat(F.lit("t"), F.col("id"), F.when(F.col("id") % 5 == 0, "").otherwise("."))).alias("text"))
    kept, report = _repaired(spark, rows, chunk=1000)
    plain = [(r["role"], r["text"]) for r in rows.orderBy("turn").collect()]
    kinds = faults(plain)
    assert report[1]["duplicate"] == kinds.count("duplicate") and report[1]["truncated"] == kinds.count("truncated")
    roles = "".join(r[:1] for e, r, _ in kept[1] if e != "D")
    assert re.fullmatch("s?(ua)+", roles)
    cost = {"K": 0, "R": 2, "D": 3, "I": 2}
    paid = sum(cost[e] for e, _, _ in kept[1])
    went = {t for e, _, t in kept[1] if e == "D"}
    assert report[1]["cost"] == paid + sum(k == "truncated" and t not in went for k, (_, t) in zip(kinds, plain, strict=True))
    whole, _ = _repaired(spark, rows)
    assert whole[1] == kept[1]


def test_repair_awkward_and_empty(spark):
    rows = [(1, 1, None, None), (1, 2, "user", "hi."), (1, 2, "user", "hi."), (None, None, None, None), (2, 2**63 - 1, "user", "x."),
            (2, -2**63, "assistant", B.LONG), (3, None, "user", "a."), (3, None, "user", "a.")]
    kept, report = _repaired(spark, spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], CONV))
    assert report[1]["audit"] == "DKDI" and report[1]["blank"] == 1 and report[1]["duplicate"] == 1
    assert report[None]["audit"] == "D" and report[2]["gaps"] == 0 and report[3]["gaps"] == 0
    edits, empty = op11_repair.repair(spark.createDataFrame([], CONV))
    assert edits.collect() == [] and empty.collect() == []


def test_repair_query_lists_every_conversation(spark, tmp_dir):
    # One row each, so some conversations lose all of theirs.
    rows = spark.createDataFrame([(i, 0, "user", "q.") for i in range(60)], "conv_id bigint, turn bigint, role string, text string")
    rows.write.parquet(f"{tmp_dir}/conversations.parquet")
    out = {r["conv_id"]: r for r in op11_repair.op11_repair(spark, tmp_dir).collect()}
    assert sorted(out) == list(range(60))
    gone = [i for i in range(60) if B.crc(f"{i}:0") % 20 == 0]
    assert gone
    for i in gone:
        assert tuple(out[i])[1:] == (0, 0, 0, 0, 0, 0, "", B.sha(""))


# --- op12 -------------------------------------------------------------------------

def plain_fim(doc_id, text):
    text = text or ""
    w = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(w)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fenwick():
    rng = random.Random(3)
    for n in [0, 1, 2, 3, 7, 8, 9, 100]:
        counts = np.array([rng.randint(0, 4) for _ in range(n)], np.int64)
        tree = op12_fim.Fenwick(counts)
        assert [tree.prefix(i) for i in range(n + 1)] == [int(counts[:i].sum()) for i in range(n + 1)]
        for k in range(int(counts.sum())):
            at, rest = tree.descend(k)
            assert counts[:at].sum() + rest == k and rest < counts[at]


def test_fim_equals_plain_version(spark):
    docs = B.awkward(spark).select("doc_id", "text", "lang", "spans", F.lit(1).alias("n"), F.lit("q").alias("form"), F.lit(2).alias("output"))
    more = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["<P> x", "a <S", "tail <", "<<P", "<M>", "é" * 3000, "x" * 5000, "日本語abc " * 700, "a\r\n\x00b", "😀", "P>", "<M"] * 6, 1000)],
        "doc_id bigint, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    got = op12_fim.transform(docs).withColumn("back", op12_fim.restored())
    want = collections.Counter((r["doc_id"], *plain_fim(r["doc_id"], r["text"]), r["text"] or "") for r in docs.collect())
    rows = collections.Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"])
                               for r in got.collect())
    assert rows == want
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}
    assert op12_fim.transform(B.empty(spark)).collect() == []


# --- op13 -------------------------------------------------------------------------

def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", B.lower(text))
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(up), 2):
        if (a ^ b).bit_count() <= 4:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {p: find(p) for p in up}


def _check_classes(rows):
    """rows: (doc_id, text, fingerprint, component_id)."""
    assert all(plain_print(t) == p for _, t, p, _ in rows)
    where = plain_components({p for _, _, p, _ in rows})
    least = {}
    for i, _, p, _ in rows:
        if i is not None:
            least[where[p]] = min(i, least.get(where[p], i))
    assert all(c == least.get(where[p]) for _, _, p, c in rows)


def test_simhash_equals_plain_version(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = op13_simhash.op13_simhash(spark, SF001).collect()
    assert len(got) == len(texts)
    _check_classes([(r["doc_id"], texts[r["doc_id"]], int(r["fingerprint"], 16), r["component_id"]) for r in got])


def test_simhash_awkward_rows(spark):
    docs = B.awkward(spark).withColumn("print", F.lit("x")).withColumn("component", F.lit(1))
    got = op13_simhash.classes(docs).collect()
    text = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    prints = collections.Counter((r["doc_id"], r["print"] % 2**64) for r in got)
    assert prints == collections.Counter((i, plain_print(t)) for (i, t), n in text.items() for _ in range(n))
    nothing = {r["component_id"] for r in got if r["print"] == 0}
    assert nothing == {1}
    assert op13_simhash.classes(B.empty(spark)).collect() == []


@pytest.mark.parametrize("tile", [op13_simhash.TILE, 16])
def test_links_join_the_same_fingerprints(spark, tile):
    rng = random.Random(11)
    prints = set()
    for _ in range(40):                      # families, close and loose, and strangers
        seed = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            p = seed
            for _ in range(rng.randint(0, 6)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    prints |= {(0xABCDE << 43) | (i << 3) for i in range(60)}        # one bucket of most tables
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    got = op13_simhash.links(spark.createDataFrame(signed, "print bigint"), tile=tile).collect()
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 4 for r in got)
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in got:
        a, b = find(r["a"] % 2**64), find(r["b"] % 2**64)
        up[max(a, b)] = min(a, b)
    assert {p: find(p) for p in prints} == plain_components(prints)


def test_forest_of_a_dense_bucket_is_small():
    rng = random.Random(2)
    values = np.array(sorted({sum(1 << b for b in rng.sample(range(12), 2)) for _ in range(2000)}), np.uint64)
    a, b = op13_simhash.forest(values, np.array([len(values)]))
    assert len(a) == len(values) - 1                     # all within 4 bits: a tree, not all pairs
