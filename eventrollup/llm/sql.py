"""DuckDB SQL of the queries whose results SQL can express."""

from __future__ import annotations

from eventrollup.llm import op1_shard, op3_neardup, op6_decontaminate, op8_quality, op9_chat, op12_fim

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 of a text: its bytes folded into the register eight bit steps at a time.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode({t})), '..'),
                                                     lambda h: ('0x' || h)::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                          lambda r, z: xor(r >> 1, (r & 1) * 3988292384::UBIGINT))))::BIGINT"""

OP1 = f"""
WITH slim AS (
    SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
           {_CRC32.format(t="coalesce(text, '')")} AS text_crc32,
           coalesce('=' || source, '') AS stratum,
           md5('{op1_shard.SEED}' || coalesce(':' || doc_id, '')) AS lot
    FROM documents),
ranked AS (
    SELECT *, ((row_number() OVER (PARTITION BY stratum ORDER BY lot, doc_id, text_crc32, size) - 1)::DOUBLE
               + ('0x' || md5('{op1_shard.SEED}/' || stratum)[1:8])::UBIGINT::DOUBLE / 4294967296.0::DOUBLE)
              / (count(*) OVER (PARTITION BY stratum))::DOUBLE AS fraction
    FROM slim),
placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, stratum, lot, doc_id, text_crc32, size) - 1 AS p,
           count(*) OVER () AS n
    FROM ranked),
cut AS (SELECT *, (p * {op1_shard.SHARDS}) // n AS k FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, k::INTEGER AS shard,
       p - (k * n + {op1_shard.SHARDS - 1}) // {op1_shard.SHARDS} AS slot,
       NULL::INTEGER AS grown_shard, source
FROM cut
"""

OP3 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                      '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < {op3_neardup.SHINGLE} THEN [w]
        ELSE list_transform(range(1, len(w) - {op3_neardup.SHINGLE - 2}),
                            lambda i: w[i:i + {op3_neardup.SHINGLE - 1}]) END) AS s
    FROM words),
hashed AS (SELECT doc_id, md5(array_to_string(s, ' ') || len(s)) AS s FROM shingle),
sizes AS (SELECT doc_id, count(*) AS n FROM hashed GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM hashed a JOIN hashed b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * n_both >= {op3_neardup.PERCENT} * (p.n + q.n - n_both)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT x, y FROM edges
    UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN lowest ON lowest.x = d.doc_id
"""

_WORD6 = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_N6 = op6_decontaminate.WINDOW

OP6 = f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD6}') AS w
    FROM documents),
item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD6}') AS w
    FROM benchmark),
item_window AS (
    SELECT DISTINCT item_id, len(win) AS size, array_to_string(win, ' ') AS win FROM (
        SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - {_N6 - 1}) + 1),
                                              lambda i: w[i:i + least(len(w), {_N6}) - 1])) AS win
        FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
    SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos, w
    FROM doc, lengths WHERE len(w) >= size),
hit AS (
    SELECT d.doc_id, d.pos, d.size, i.item_id
    FROM (SELECT doc_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS win FROM doc_window) d
    JOIN item_window i ON i.size = d.size AND i.win = d.win),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CLASS_PATTERNS = {
    "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": "[\\x20\\x09-\\x0D]",
    "symbol": "[#*$%&|<>]", "punct": "[!\"''()+,./:;=?@\\[\\\\\\]^_`{}~-]",
}
_COUNTS = ",\n           ".join(
    f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) AS c_{c}" for c, p in _CLASS_PATTERNS.items())
_OTHER = " - ".join(["length(t)", *[f"c_{c}" for c in _CLASS_PATTERNS]])
_TERM = op8_quality.APART.replace("[", "[^", 1)


def _bin(p: str, q: str) -> str:
    return (f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END / 2"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END / 2)")


OP8 = f"""
WITH src AS (
    SELECT doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
cut AS (
    SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l,
           {_COUNTS}
    FROM src),
win AS (
    SELECT doc_id, i, list_extract(w, i) || ' ' || list_extract(w, i + 1) || ' ' || list_extract(w, i + 2) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1),
repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY 1),
m AS (
    SELECT cut.doc_id, stratum, len(w) AS n_words, length(t) AS n_chars, length(t) - c_space AS word_chars, c_symbol AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(w) < {op8_quality.MIN_WORDS} OR 100 * coalesce(n, 0) > {op8_quality.MAX_REPEAT_PERCENT} * len(w) AS base_failed,
           [c_lower, c_upper, c_digit, c_space, c_symbol, c_punct, {_OTHER}] AS classes,
           regexp_extract_all(lower(t), '{_TERM}') AS terms, len(terms) AS n_terms
    FROM cut LEFT JOIN repeated USING (doc_id)),
term AS (
    SELECT doc_id, stratum, base_failed, n_words, n_terms, word, count(*) AS n
    FROM (SELECT doc_id, stratum, base_failed, n_words, n_terms, unnest(terms) AS word FROM m) GROUP BY ALL),
counted AS (
    SELECT stratum, word, sum(n) AS n FROM term GROUP BY ALL
    UNION ALL SELECT '*', word, sum(n) FROM term GROUP BY ALL),
vocabulary AS (
    SELECT DISTINCT word FROM counted
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY n DESC, word) <= {op8_quality.TOP_WORDS}),
doc_word AS (SELECT * FROM term WHERE word IN (SELECT word FROM vocabulary)),
doc_class AS (SELECT doc_id, stratum, base_failed, n_chars, unnest(range(1, 8)) AS bin, unnest(classes) AS n FROM m),
enough AS (
    SELECT stratum, sum(n_words) AS total FROM m WHERE NOT base_failed GROUP BY stratum
    HAVING count(*) >= {op8_quality.MIN_REFERENCE_DOCS}),
-- The reference of a stratum: its own rows if it has enough, else all rows.
chosen AS (SELECT DISTINCT m.stratum, e.stratum IS NOT NULL AS own FROM m LEFT JOIN enough e USING (stratum)),
ref_total AS (
    SELECT c.stratum, sum(m.n_terms) AS n_terms, sum(m.n_chars) AS n_chars
    FROM chosen c JOIN m ON NOT m.base_failed AND (NOT c.own OR m.stratum = c.stratum) GROUP BY c.stratum),
ref_word AS (
    SELECT c.stratum, d.word, sum(d.n) / any_value(r.n_terms) AS q
    FROM chosen c JOIN ref_total r USING (stratum)
    JOIN doc_word d ON NOT d.base_failed AND (NOT c.own OR d.stratum = c.stratum) GROUP BY c.stratum, d.word),
ref_class AS (
    SELECT c.stratum, d.bin, sum(d.n) / any_value(r.n_chars) AS q
    FROM chosen c JOIN ref_total r USING (stratum)
    JOIN doc_class d ON NOT d.base_failed AND (NOT c.own OR d.stratum = c.stratum) GROUP BY c.stratum, d.bin),
class_distance AS (
    SELECT doc_id, sqrt(greatest(0, sum({_bin("p", "q")}))) AS v
    FROM (SELECT d.doc_id, d.n / d.n_chars AS p, coalesce(q, 0) AS q
          FROM doc_class d LEFT JOIN ref_class r ON r.stratum = d.stratum AND r.bin = d.bin
          WHERE d.n_chars >= {op8_quality.MIN_CLASS_CHARS}) GROUP BY doc_id),
word_bins AS (
    SELECT m.doc_id, coalesce(d.n / m.n_terms, 0) AS p, r.q
    FROM m JOIN ref_word r USING (stratum) LEFT JOIN doc_word d ON d.doc_id = m.doc_id AND d.word = r.word
    WHERE m.n_words >= {op8_quality.MIN_COMMON_WORDS}
    UNION ALL
    SELECT d.doc_id, d.n / d.n_terms, 0
    FROM doc_word d LEFT JOIN ref_word r ON r.stratum = d.stratum AND r.word = d.word
    WHERE r.word IS NULL AND d.n_words >= {op8_quality.MIN_COMMON_WORDS}),
word_rest AS (
    SELECT doc_id, greatest(0, 1 - sum(p)) AS p, greatest(0, 1 - sum(q)) AS q FROM word_bins GROUP BY doc_id),
word_distance AS (
    SELECT doc_id, sqrt(greatest(0, sum({_bin("p", "q")}))) AS v
    FROM (SELECT * FROM word_bins UNION ALL SELECT * FROM word_rest) GROUP BY doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(c.v, 0) <= {op8_quality.MAX_CLASS_DISTANCE}
       AND coalesce(x.v, 0) <= {op8_quality.MAX_WORD_DISTANCE} AS kept
FROM m LEFT JOIN class_distance c USING (doc_id) LEFT JOIN word_distance x USING (doc_id)
"""


def _escaped(c: str) -> str:
    return f"regexp_replace({c}, '<(\\\\*)\\|', '<\\1\\\\|', 'g')"


OP9 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{op9_chat.PROBE}'), (-1, 1, 'assistant', '{op9_chat.PROBE}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{op9_chat.LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = '{op9_chat.LOSS_ROLE}'), '')) AS loss_sha256,
       sum({len(op9_chat.START) + len(op9_chat.STOP) + 2} + length({_escaped("role")})
           + length({_escaped("text")}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_SPACE = "[\\x20\\x09-\\x0D]"
# A state of the walk: cost, letters, messages so far.
_NEVER = "{'c': 1000000, 'a': '', 'b': []::VARCHAR[]}"


def _edit(state: str, cost: str, letter: str, message: str | None) -> str:
    body = f"list_append({state}.b, {message})" if message else f"{state}.b"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'b': {body}}}"


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _if(cond: str, state: str) -> str:
    return f"CASE WHEN {cond} THEN {state} ELSE {_NEVER} END"


_USER, _ASSISTANT = "'user:'", "'assistant:'"
_KEEP, _GO = "role || ':' || text", "fault IN ('blank', 'duplicate')"


def _kept(state: str, initial: str) -> str:
    return _if(f"NOT {_GO} AND initial = '{initial}'", _edit(state, "extra", "K", _KEEP))


def _reroled(state: str, role: str) -> str:
    return _if(f"NOT {_GO}", _edit(state, "2 + extra", "R", f"{role} || text"))


def _gone(state: str) -> str:
    return _edit(state, "3", "D", None)


OP11 = f"""
WITH RECURSIVE lots AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC32.format(t="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS lot
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
           CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN lot = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM lots WHERE lot <> 0),
placed AS (
    SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
judged AS (
    SELECT conv_id, turn, role, text, i, before, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS k,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN k > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?]{_SPACE}*$') THEN 'truncated' ELSE '' END AS fault,
           (fault = 'truncated')::INTEGER AS extra
    FROM placed),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'b': []::VARCHAR[]}} AS n, {_NEVER} AS s,
           {{'c': 2, 'a': 'I', 'b': [{_USER}]}} AS u, {{'c': 4, 'a': 'II', 'b': [{_USER}, {_ASSISTANT}]}} AS a
    FROM damaged
    UNION ALL
    SELECT conv_id, i, n, s, u,
           {_least("a", _edit("u", "2", "I", _ASSISTANT))}
    FROM (SELECT conv_id, i, n, s, a,
                 {_least("u", _edit("n", "2", "I", _USER), _edit("s", "2", "I", _USER), _edit("a", "2", "I", _USER))} AS u
          FROM (SELECT w.conv_id, j.i, {_gone("w.n")} AS n,
                       {_least(_gone("w.s"), _kept("w.n", "s"))} AS s,
                       {_least(_gone("w.u"), *[_kept(f"w.{q}", "u") for q in "nsa"], *[_reroled(f"w.{q}", _USER) for q in "nsa"])} AS u,
                       {_least(_gone("w.a"), _kept("w.u", "a"), _reroled("w.u", _ASSISTANT))} AS a
                FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1))),
ended AS (
    SELECT conv_id, {_least("n", "a")} AS best
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM walk) WHERE back = 1),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.b, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP12 = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('{op12_fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, len(w)::BIGINT AS n,
           ('0x' || h[1:8])::UBIGINT::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::UBIGINT::BIGINT % (n + 1) AS y,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                  OR ('0x' || h[17:24])::UBIGINT % 100 >= {op12_fim.FIM_PERCENT} THEN 'plain'
                WHEN ('0x' || h[25:32])::UBIGINT % 100 < {op12_fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
made AS (
    SELECT doc_id, t, n, form, coalesce(array_to_string(w[1:least(x, y)], ''), '') AS p,
           coalesce(array_to_string(w[least(x, y) + 1:greatest(x, y)], ''), '') AS m,
           coalesce(array_to_string(w[greatest(x, y) + 1:], ''), '') AS s
    FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM made
"""

ORACLES = {
    "op11_repair": OP11,
    "op12_fim": OP12,
    "op1_shard": OP1,
    "op3_neardup": OP3,
    "op6_decontaminate": OP6,
    "op8_quality": OP8,
    "op9_chat": OP9,
}
