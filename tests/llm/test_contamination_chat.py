"""Decontamination and chat formatting."""

import collections
import random

import llm_brute as B
from conftest import SF001, SF0001

from eventrollup.llm import op6_decontaminate as D
from eventrollup.llm import op9_chat as C


def test_contamination_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in D.op6_decontaminate(spark, SF0001).collect())
    assert got == sorted(B.contamination(docs, items))
    assert any(r[-1] for r in got)


def _frames(spark):
    rng = random.Random(8)
    word = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(word, k=rng.choice((0, 1, 2, 5, 13, 20, 40))))) for i in range(12)]
    items += [(3, items[4][1]), (50, None), (51, "")]
    docs = [(i, " ".join(rng.choices(word, k=rng.randint(0, 300)))) for i in range(40)]
    docs += [(100 + i, docs[i][1] + ". " + (items[i][1] or "").upper() + "! tail") for i in range(12)]
    return docs, items


def test_contamination_short_and_tied_items(spark):
    docs, items = _frames(spark)
    index = D.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    # One block of queries, and blocks of a few words each.
    for limit in (10**6, 30):
        got = [(r["doc_id"], r["n_words"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["items"]),
                B.sha(",".join(r["items"]))) for r in D.search(index, frame, max_words=limit).collect()]
        assert sorted(got) == sorted(r[:5] for r in B.contamination(docs, items))


def test_contamination_awkward_rows(spark):
    docs = B.awkward(spark)
    items = [(1, "quick brown fox jumps over the lazy dog and runs far away from the"), (2, "one"), (3, None)]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = collections.Counter(
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), B.sha(",".join(r["items"])), r["contaminated"])
        for r in D.contamination(docs, frame).collect())
    assert got == collections.Counter(B.contamination([(r["doc_id"], r["text"]) for r in docs.collect()], items))
    kept = D.drop_contaminated(docs, frame)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 0, 1, 2, 3, 6, 7, 12, 13, 14, 15]
    assert D.contamination(B.empty(spark), frame).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.drop_contaminated(docs, none).count() == docs.count()


def test_proximity(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "alpha x x x x x x beta gamma"), (3, "beta alpha"), (4, "gamma beta alpha alpha")]
    index = D.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    queries = spark.createDataFrame([("q", "alpha BETA gamma")], "item_id string, text string")
    assert {r["doc_id"] for r in D.proximity(index, queries, 6).collect()} == {1, 4}
    assert {r["doc_id"] for r in D.proximity(index, queries, 9).collect()} == {1, 2, 4}
    assert {r["doc_id"] for r in D.proximity(index, queries, 3).collect()} == {4}


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(20_000):
        x = "".join(rng.choices(["<", "|", "\\", "a", "im_end", "<|", ">", "\n", "n", C.STOP], k=rng.randint(0, 12)))
        assert C.unescape(C.escape(x)) == x and "<|" not in C.escape(x)
        assert C._unrole(C._role(x)) == x and "\n" not in C._role(x)


def test_chat_query(spark):
    talks = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn").collect():
        talks[r["conv_id"]].append((r["role"], r["text"] or ""))
    talks[-1] = [("user", C.PROBE), ("assistant", C.PROBE)]
    for r in C.op9_chat(spark, SF001).collect():
        turns = talks.pop(r["conv_id"])
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(turns), B.sha("".join(f"{a}\n{t}\n" for a, t in turns)), len(loss), B.sha(loss))
    assert not talks


def _events(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, seq bigint, row bigint, kind string, role string, text string, target int")


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 9, 0, "delta", None, "!", None), (1, 1, 0, "open", "user", "hel", None), (1, 2, 0, "delta", None, "lo", None),
        (1, 3, 0, "open", "assistant", None, None), (1, 4, 0, "delta", None, "wrong", None),
        (1, 5, 0, "regenerate", None, None, None), (1, 6, 0, "delta", None, "right", None),
        (1, 7, 0, "edit", None, "goodbye", 0), (1, 8, 0, "edit", None, "nothing", 7),
        (2, 1, 0, "delta", None, "lost", None), (2, 2, 0, "edit", None, "lost", 0),
        (None, 1, 1, "delta", None, "b", None), (None, 1, 0, "open", "assistant", "a", None), (None, 1, 2, "unknown", None, "c", None),
    ]
    parts = C.format_chats(_events(spark, log))
    text = {(r["conv_id"], r["part"]): r["formatted"] for r in parts.collect()}
    assert text == {(1, 0): "<|im_start|>user\ngoodbye<|im_end|>\n", (1, 1): "<|im_start|>assistant\nright!<|im_end|>\n",
                    (None, 0): "<|im_start|>assistant\nab<|im_end|>\n"}
    got = {r["conv_id"]: r for r in C.read_chats(parts).collect()}
    assert got[1]["loss_sha256"] == B.sha("right!") and got[1]["n_turns"] == 2 and got[None]["loss_chars"] == 2


def test_chat_awkward_rows(spark):
    rows = [(1, 0, None, None, "x"), (1, 0, None, None, "x"), (1, None, "user", "first", "y"),
            (1, 5, "assistant", "é" * 100_000 + C.STOP, "z"), (1, 6, "a\nb\\|<|", "", "w"), (None, 0, "assistant", "t", "v")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, kind string")
    got = {r["conv_id"]: r for r in C.read_chats(C.format_chats(C.events_of(given))).collect()}
    turns = [("user", "first"), ("", ""), ("", ""), ("assistant", rows[3][3]), ("a\nb\\|<|", "")]
    assert got[1]["n_turns"] == 5
    assert got[1]["turns_sha256"] == B.sha("".join(f"{a}\n{t}\n" for a, t in turns))
    assert got[1]["loss_chars"] == len(rows[3][3]) and got[None]["loss_chars"] == 1
    assert C.read_chats(C.format_chats(C.events_of(given.where("false")))).collect() == []
