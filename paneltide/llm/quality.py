"""Quality rules with distribution divergence (operator 3, native).

Each text's histograms of character classes and of its language's common words are compared, by
Jensen-Shannon distance, with references that are summed over every document of that language. Short
texts say little about a distribution, so each comparison has a minimum length below which it passes.
All counting happens within a row; only per-language sums are shuffled. Windows of three words are compared by
a 64-bit hash within one text, so two of n windows are taken for equal by chance once in 2^65 / n^2 texts.

Defined results: a null text has no words and fails the base rules; a null language, or one of fewer
than ``min_docs`` documents, is compared with the whole table's character classes and not by words; so are
languages without a word list, though by their own classes; very long texts are counted whole; a distance
equal to its limit passes; repeated rows are each judged; other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

#: Common words of each language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "on", "be", "by"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "est", "dans", "pour", "par"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}
#: Java and RE2 patterns of what isn't in the class; the last class is the rest.
CLASSES = (("lower", r"\P{Ll}+"), ("upper", r"\P{Lu}+"), ("digit", r"\P{N}+"), ("space", r"[^\x20\x09-\x0D]+"), ("stop", r"[^.,;:!?]+"))
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MAX_CLASS_DISTANCE = 0.27
MAX_WORD_DISTANCE = 0.30



def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, lang, base counts, class counts and common-word counts (arrays of long)."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    t = t.withColumn("n_words", F.size("words").cast("long"))
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    t = t.withColumn("grams", F.when(F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(F.array().cast("array<bigint>")))
    placed = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
    t = t.withColumn("placed", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), placed))
    again = F.filter("placed", lambda x, i: (F.get("placed", i - 1)["g"] == x["g"]) | (F.get("placed", i + 1)["g"] == x["g"]))
    covered = F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    t = t.withColumn("n_repeat_words", F.when(F.col("placed").isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered))).cast("long"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    t = t.withColumn("lines", lines)
    n = F.length("text")
    classes = [F.length(F.regexp_replace("text", pattern, "")).cast("long") for _, pattern in CLASSES]
    t = t.withColumn("classes", F.array(*classes)).withColumn("n_chars", n.cast("long"))
    lists = F.lit(None).cast("array<string>")
    for lang, words in COMMON_WORDS.items():
        lists = F.when(F.col("lang") == lang, F.array(*map(F.lit, words))).otherwise(lists)
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    found = F.filter(F.transform("words", F.lower), lambda w: w.isin(every))
    t = t.withColumn("list", lists).withColumn("found", F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" ")))
    count = lambda w: ((F.length("found") - F.length(F.replace(F.col("found"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.length(w) + 2)).cast("long")
    return t.select(
        "doc_id", "lang", "n_words",
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (n - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_chars",
        F.concat("classes", F.array(F.col("n_chars") - F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x))).alias("classes"),
        F.transform("list", count).alias("common"),
    )


def with_rest(counts: Column, total: Column) -> Column:
    return F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts; null if either sums to 0."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    share = lambda c: F.transform(c, lambda x: F.try_divide(x.cast("double"), total(c)))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    both = F.zip_with(share(p), share(q), lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))



def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_docs: int = 20, min_chars: int = 200, min_words: int = 100,
          max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per row: id, n_words, base counts, base_failed, kept, class_distance, word_distance."""
    stats = cut(document_stats(docs, id_col, text_col, lang_col)).withColumn("common", with_rest(F.col("common"), F.col("n_words")))
    n_classes, n_common = len(CLASSES) + 1, 1 + max(map(len, COMMON_WORDS.values()))
    sums = [F.sum(F.get("classes", F.lit(i))) for i in range(n_classes)], [F.sum(F.get("common", F.lit(i))) for i in range(n_common)]
    refs = (
        stats.where("lang is not null").groupBy("lang").agg(F.count("*").alias("docs"), F.array(*sums[0]).alias("ref_classes"), F.array(*sums[1]).alias("ref_common"))
        .where(F.col("docs") >= min_docs)
    )
    whole = stats.agg(F.array(*sums[0]).alias("ref")).scalar()
    joined = stats.join(refs.select("lang", "ref_classes", "ref_common"), "lang", "left").withColumn("ref_classes", F.coalesce("ref_classes", whole))
    measured = joined.withColumn("class_distance", distance(F.col("classes"), F.col("ref_classes"))).withColumn("word_distance", distance(F.col("common"), F.col("ref_common")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    apart = ((F.col("n_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)) | ((F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance))
    return measured.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.coalesce(apart, F.lit(False))).alias("kept"), "class_distance", "word_distance",
    )
