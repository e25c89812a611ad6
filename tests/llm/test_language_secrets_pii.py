"""Language ID, secrets and personal data."""

import random
import zlib

import llm_brute as B
from conftest import SF001, SF0001

from eventrollup.llm import op5_langid, op7_secrets, op10_pii


def _documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in _documents(spark, SF001).select("doc_id", "lang").collect()}
    rows = op5_langid.op5_langid(spark, SF001).collect()
    assert {r["doc_id"] for r in rows} == set(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_language_awkward_rows(spark):
    docs = B.awkward(spark)
    model = op5_langid.train(_documents(spark, SF0001).select("doc_id", "text", "lang"))
    got = {r["doc_id"]: r for r in op5_langid.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 12))
    assert got[8]["lang_pred"] == "en" and got[15]["lang_pred"] in model.languages
    kept = op5_langid.keep_identified(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        [0, 0, 4, 5, 6, 7, 8, 8, 9, 10, 11, 13, 14, 15])
    # Nothing to learn from: everything is unknown.
    assert op5_langid.train(B.empty(spark)) is None
    assert {r["lang_pred"] for r in op5_langid.predict(docs, None).collect()} == {"und"}
    assert op5_langid.predict(B.empty(spark), model).collect() == []


def test_kernel_is_presence_not_frequency():
    assert (op5_langid.presence("abc abc abc") == op5_langid.presence("abc abc")).all()
    assert not len(op5_langid.presence("123 !!"))


def test_secret_base_spans(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in _documents(spark, SF001).collect()}
    for r in op7_secrets.op7_secrets(spark, SF001).collect():
        want = B.secret_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == B.sha(B.joined(want))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for k, _, _ in want) for n in ("assign", "access", "hex")]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("markov")] == [f"{k}:{a}:{b}" for k, a, b in want]


def test_markov_finds_what_the_patterns_miss(spark):
    rng = random.Random(4)
    digits = "0123456789abcdef"
    rows = [(i, f"token = {''.join(rng.choices(digits, k=40))} and more words around it") for i in range(60)]
    rows += [(100 + i, "ordinary_identifier_names and understandable_function_call plus internationalization") for i in range(60)]
    # Upper-case hex escapes the base patterns; a lower-case word run does not look random.
    rows += [(900, "see AB12 x9f3c01d77e55b2a90c4d8e6 here"), (901, "the counterrevolutionarytransformations here")]
    out = {r["doc_id"]: r["spans"] for r in op7_secrets.find_secrets(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(s["kind"], s["start"], s["stop"]) for s in out[900]] == [("markov", 9, 33)]
    assert out[901] == [] and all(not out[i] for i in range(100, 160))


def test_markov_spans_equal_plain_version(spark):
    """Runs of every length from 8 on, among them keys of 8 to 19 characters."""
    rng = random.Random(6)
    rows = [r["text"] or "" for r in _documents(spark, SF0001).collect()]
    rows += [f"token = {''.join(rng.choices('0123456789abcdefXYZ', k=30))}, é words" for _ in range(40)]
    rows += [f"é the value {''.join(rng.choices('0123456789abcdefXYZ', k=rng.randint(5, 19)))} stands alone" for _ in range(60)]
    want = B.markov_spans(rows, lambda t: B.secret_spans(t), op7_secrets.ALPHABET, op7_secrets.MIN_RUN, op7_secrets.MIN_RATIO)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"] if s["kind"] == "markov"] for r in op7_secrets.find_secrets(frame).collect()}
    assert [got[i] for i in range(len(rows))] == want
    short = [b - a for spans in want for a, b in spans if b - a < 20]
    assert len(short) > 20


def test_secrets_awkward_rows(spark):
    docs = B.awkward(spark)
    got = op7_secrets.find_secrets(docs).collect()
    assert len(got) == docs.count()
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"] if s["kind"] != "markov"] for r in got}
    for r in docs.collect():
        if r["doc_id"] is not None:
            assert spans[r["doc_id"]] == B.secret_spans(r["text"] or "")
    assert op7_secrets.find_secrets(B.empty(spark)).collect() == []


def test_personal_base_spans_fuzz():
    rng = random.Random(2)
    pieces = [*"a1.@-+ (%9", "a@b.c", "1.2.3.4", "+123 456", "4111 1111 1111 1111", "4111-1111", "é", "256.1.1.1"]
    for _ in range(20_000):
        t = "".join(rng.choices(pieces, k=rng.randint(0, 25)))
        assert [(op10_pii.KINDS[k], a, b) for k, a, b in op10_pii.base_spans(t)] == B.personal_spans(t), t


def test_personal_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in _documents(spark, SF001).collect()}
    for r in op10_pii.op10_pii(spark, SF001).collect():
        want = B.personal_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == B.sha(B.joined(want))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(k == n for k, _, _ in want) for n in ("email", "ip", "card", "phone")]


def test_disclosing_terms_are_found(spark):
    filler = "plain words of the corpus that stand in every document of this table "
    rows = [(i, filler + f"Zanzibarov writes from jan.doe@example.org about plain words number {i}") for i in range(5)]
    rows += [(100 + i, filler * 3 + f"unique{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in op10_pii.find_personal(frame).collect()}
    for i in range(5):
        names = {rows[i][1][s["start"]:s["stop"]] for s in out[i]["terms"]}
        assert "Zanzibarov" in names and "plain" not in names and "words" not in names
    assert all(not out[100 + i]["terms"] for i in range(300))
    clean = {r["doc_id"]: r["text"] for r in op10_pii.sanitise(frame).collect()}
    assert "jan.doe" not in clean[0] and "[EMAIL]" in clean[0] and "Zanzibarov" not in clean[0] and "[TERM]" in clean[0]
    assert clean[100] == rows[5][1]


def test_context_has_ten_words_however_far():
    for gap in (" ", " " * 500, "-" * 3000):
        for word in ("w", "語" * 700):
            words = [f"{word}{i}" for i in range(24)]
            text = gap.join([*words[:12], "a@b.c", *words[12:]])
            start = text.index("a@b.c")
            near = [text[x:y] for x, y in op10_pii._around(text, start, start + 5)]
            assert near == words[2:22]


def test_disclosing_terms_go_wherever_they_stand(spark):
    filler = "plain words of the corpus that stand in every document of this table "
    far = filler * 3 + "é Zanzibarov, zanzibarov@example.com "
    rows = [(i, f"Zanzibarov writes from jan.doe@example.org {far}") for i in range(5)]
    rows += [(50, far), (51, "ZANZIBAROV alone"), (52, "Zanzibarova is another word")]
    rows += [(100 + i, filler * 3 + f"unique{i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["terms"]] for r in op10_pii.find_personal(frame).collect()}
    at = far.index("Zanzibarov")
    assert out[50] == [(at, at + 10)] and out[51] == [(0, 10)] and out[52] == []
    assert all((0, 10) in out[i] and any(a > 100 for a, _ in out[i]) for i in range(5))
    clean = {r["doc_id"]: r["text"] for r in op10_pii.sanitise(frame).collect()}
    assert clean[51] == "[TERM] alone" and "[TERM], [EMAIL]" in clean[50] and clean[52] == rows[7][1]
    assert not any("zanzibarov" in clean[i].lower() for i in [*range(5), 50])


def test_personal_awkward_rows(spark):
    docs = B.awkward(spark)
    out = op10_pii.sanitise(docs)
    assert out.schema == docs.schema
    rows = out.collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["text"] is None and by[2]["text"] == ""
    assert by[13]["text"] == "mail [EMAIL] or [IP], card [CARD], call [PHONE]"
    assert by[13]["n_chars"] == len(by[13]["text"]) and by[13]["key"] == "k"
    assert by[6]["text"] == B.LONG
    assert op10_pii.sanitise(B.empty(spark)).collect() == []
    assert op10_pii.find_personal(B.empty(spark)).collect() == []


def test_long_texts_without_backtracking():
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "1 " * 100_000, "a@" * 100_000):
        op10_pii.base_spans(t)
