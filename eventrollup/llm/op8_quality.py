"""Quality rules by distribution divergence (DataFrame functions only).

Every document gets the base rules (word and symbol counts, duplicate lines,
repeated three-word windows) and two histograms: seven character classes, and
the common words of the table's languages.  Which words are common is counted:
the ``TOP_WORDS`` most frequent ones, in lower case and parted by white space and
ASCII punctuation, over all documents of a language, whatever languages the table
holds.  Both histograms are compared by
Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) with a
reference histogram of the document's language, pooled over all documents of
that language that pass the base rules.  A document is kept if it passes the
base rules and neither distance exceeds its threshold; a distance is judged
only above a minimum length, as short texts scatter.

Defined results: a null or empty text has no words and fails the base rules; a
null language, or one with fewer than ``MIN_REFERENCE_DOCS`` passing documents,
is compared with the reference pooled over all languages; a text without
characters has no class distance; repeated rows are judged one by one; an empty table gives no rows; other columns are not read.
Equality of three-word windows is decided on 64-bit hashes inside one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, store

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_REFERENCE_DOCS = 20
# Guards: below these lengths a distance is not judged.
MIN_CLASS_CHARS = 300
MIN_COMMON_WORDS = 100
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45

TOP_WORDS = 25                    # of every language, and of all together
# White space and ASCII punctuation: what parts the words of the histogram.
APART = "[\\x20\\x09-\\x0D!-/:-@\\[-`{-~]+"
SPACE = "[\\x20\\x09-\\x0D]+"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punct", "other")


def _removed(text: Column, pattern: str) -> Column:
    """Code points of ``text`` that ``pattern`` matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("stratum")


def vocabulary(docs: DataFrame) -> list[str]:
    """The most frequent words of every language and of all languages together,
    over all documents.

    Counted per language and partly before the shuffle.  Only ``TOP_WORDS`` rows
    per language reach the driver: as many as the table has languages, not
    documents.
    """
    counts = store(docs.select(_stratum(), F.explode(F.split(F.lower("text"), APART)).alias("word")).where("word <> ''")
                   .groupBy("stratum", "word").agg(F.count(F.lit(1)).alias("n")), "quality-words")
    pool = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("*").alias("stratum"), "word", "n")
    # The rank limit is applied before the rows of a language meet.
    by = Window.partitionBy("stratum").orderBy(F.desc("n"), "word")
    top = counts.select("stratum", "word", "n").unionByName(pool).withColumn("rank", F.row_number().over(by)) \
        .where(F.col("rank") <= TOP_WORDS)
    return sorted(r["word"] for r in top.select("word").distinct().collect())


def measure(docs: DataFrame, common: list[str]) -> DataFrame:
    """docs(doc_id, text, lang) -> base counts and histograms, row by row."""
    d = docs.select("doc_id", _stratum(),
                    F.coalesce("text", F.lit("")).alias("text"))
    t = F.col("text")
    # All classes but the lower-case run are counted on what remains without it.
    d = d.withColumn("rest", F.regexp_replace(t, "[a-z]+", ""))
    rest = F.col("rest")
    d = d.withColumn("upper", _removed(rest, "[A-Z]+")).withColumn("digit", _removed(rest, "[0-9]+")) \
        .withColumn("space", _removed(rest, SPACE)).withColumn("symbol", _removed(rest, "[#*$%&|<>]+")) \
        .withColumn("punct", _removed(rest, "[!\"'()+,./:;=?@\\[\\\\\\]^_`{}~-]+")) \
        .withColumn("n_chars", F.length(t)).withColumn("n_rest", F.length(rest))
    d = d.withColumn("lower", F.col("n_chars") - F.col("n_rest")).withColumn(
        "other", F.col("n_rest") - reduce(lambda a, b: a + b, [F.col(c) for c in CLASSES[1:6]]))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]")))
    d = d.withColumn("words", F.filter(F.split(t, SPACE), lambda w: w != "")) \
        .withColumn("lines", lines)
    words = F.col("words")
    d = d.withColumn("n_words", F.size(words).cast("bigint")) \
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")) \
        .withColumn("windows", F.when(F.col("n_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
            .otherwise(F.array().cast("array<bigint>"))) \
        .withColumn("terms", F.array_remove(F.split(F.lower(t), APART), ""))
    d = d.withColumn("n_terms", F.size("terms").cast("bigint")).withColumn(
        "common", F.filter("terms", lambda w: w.isin(common)) if common else F.array().cast("array<string>"))
    d = d.drop("rest", "n_rest", "text", "lines", "words", "terms")
    # Only a text that repeats a window needs the windows' places.
    d = d.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    d = d.withColumn("placed", F.when(F.col("repeats"), F.array_sort(F.transform(
        F.col("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    placed = F.col("placed")
    d = d.withColumn("starts", F.when(F.col("repeats"), F.array_sort(F.transform(F.filter(
        F.transform(placed, lambda p, k: F.when(
            (F.get(placed, k - 1)["h"] == p["h"]) | (F.get(placed, k + 1)["h"] == p["h"]), p["i"])),
        lambda x: x.isNotNull()), lambda x: F.coalesce(x, F.lit(0))))))
    starts = F.col("starts")
    d = d.withColumn("n_repeat_words", F.coalesce(_total(F.transform(
        starts, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(starts, k + 1) - p), F.lit(3)).cast("bigint"))),
        F.lit(0).cast("bigint")))
    return d.select(
        "doc_id", "stratum", "n_words", "n_terms", (F.col("n_chars") - F.col("space")).cast("bigint").alias("word_chars"),
        F.col("symbol").cast("bigint").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.array(*[F.col(c).cast("bigint") for c in CLASSES]).alias("classes"),
        F.transform(F.array_distinct("common"), lambda w: F.struct(
            w.alias("word"), (F.size("common") - F.size(F.array_remove("common", w))).cast("bigint").alias("n"))).alias("common"))


def _term(p: Column, q: Column) -> Column:
    """One bin of the divergence in bits, where p + q > 0."""
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) / 2 + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0) / 2


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), divergence))


def references(measured: DataFrame) -> DataFrame:
    """(stratum, ref_docs, ref_classes, ref_words): shares per language, and the
    pool of all languages under the stratum ``*``.  One row per language."""
    good = measured.where(~F.col("base_failed"))
    sums = [F.sum(F.col("classes")[i]).alias(c) for i, c in enumerate(CLASSES)]
    by_class = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("ref_docs"), F.sum("n_terms").alias("ref_n"), *sums)
    by_word = good.select("stratum", F.explode("common").alias("c")) \
        .groupBy("stratum", F.col("c.word").alias("word")).agg(F.sum("c.n").alias("n"))
    words = by_word.groupBy("stratum").agg(F.collect_list(F.struct("word", "n")).alias("counts"))
    pool_class = by_class.agg(F.sum("ref_docs").alias("ref_docs"), F.sum("ref_n").alias("ref_n"),
                              *[F.sum(c).alias(c) for c in CLASSES]).withColumn("stratum", F.lit("*"))
    pool_words = by_word.groupBy("word").agg(F.sum("n").alias("n")) \
        .agg(F.collect_list(F.struct("word", "n")).alias("counts")).withColumn("stratum", F.lit("*"))
    joined = by_class.unionByName(pool_class).join(words.unionByName(pool_words), "stratum", "left")
    total = reduce(lambda a, b: a + b, [F.col(c) for c in CLASSES])
    return joined.select(
        "stratum", "ref_docs", F.array(*[F.try_divide(F.col(c), total) for c in CLASSES]).alias("ref_classes"),
        F.map_from_entries(F.transform(F.coalesce("counts", F.array().cast("array<struct<word:string,n:bigint>>")),
                                       lambda x: F.struct(x["word"], x["n"] / F.col("ref_n")))).alias("ref_words"))


def judge(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """Add class_distance, word_distance and kept."""
    own = refs.where((F.col("stratum") != "*") & (F.col("ref_docs") >= MIN_REFERENCE_DOCS))
    # The pool is one row by construction; it is joined as one, not broadcast by size.
    pool = refs.where(F.col("stratum") == "*").select(
        F.lit(1).alias("one"), F.col("ref_classes").alias("all_classes"), F.col("ref_words").alias("all_words"))
    d = measured.join(own, "stratum", "left").withColumn("one", F.lit(1)).join(F.broadcast(pool), "one", "left")
    d = d.withColumn("q", F.coalesce("ref_classes", "all_classes")) \
        .withColumn("r", F.coalesce("ref_words", "all_words")) \
        .withColumn("chars", _total(F.col("classes")))
    classes, common, r, q = F.col("classes"), F.col("common"), F.col("r"), F.col("q")
    zero = F.lit(0.0)
    by_class = F.aggregate(F.transform(
        classes, lambda n, i: _term(F.try_divide(n, F.col("chars")), F.get(q, i))), zero, lambda a, x: a + F.coalesce(x, zero))
    # Bins the text lacks add half the reference's share each; so only its own
    # bins are visited.  All words outside the list form one bin.
    seen = F.transform(common, lambda c: F.struct(
        (c["n"] / F.col("n_terms")).alias("p"),
        F.coalesce(F.element_at(r, c["word"]), zero).alias("q")))
    d = d.withColumn("class_divergence", by_class).withColumn("seen", seen)
    seen = F.col("seen")
    p_seen = F.aggregate(seen, zero, lambda a, x: a + x["p"])
    q_seen = F.aggregate(seen, zero, lambda a, x: a + x["q"])
    q_all = F.aggregate(F.map_values(r), zero, lambda a, x: a + x)
    d = d.withColumn("p_out", F.greatest(zero, 1 - p_seen)).withColumn("q_seen", q_seen).withColumn("q_all", q_all)
    by_word = F.aggregate(F.transform(seen, lambda x: _term(x["p"], x["q"])), zero, lambda a, x: a + x) \
        + _term(F.col("p_out"), F.greatest(zero, 1 - F.col("q_all"))) \
        + F.greatest(zero, F.col("q_all") - F.col("q_seen")) / 2
    d = d.withColumn("class_distance", F.when(F.col("chars") >= MIN_CLASS_CHARS, _distance(F.col("class_divergence")))) \
        .withColumn("word_distance", F.when(F.col("n_words") >= MIN_COMMON_WORDS, _distance(by_word)))
    passes = (F.coalesce("class_distance", zero) <= MAX_CLASS_DISTANCE) \
        & (F.coalesce("word_distance", zero) <= MAX_WORD_DISTANCE)
    return d.withColumn("kept", ~F.col("base_failed") & passes)


def quality(docs: DataFrame) -> DataFrame:
    """Texts are read twice: for the words that are common, and to be measured; the
    measured rows are stored, then pooled and judged."""
    measured = store(measure(docs, vocabulary(docs)), "quality-measured")
    return judge(measured, store(references(measured), "quality-references"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_input(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
