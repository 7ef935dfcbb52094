"""Quality rules: divergence of a document's histograms from its language's references (native DataFrame operations only).

Two histograms of a document, of character classes and of its language's most common words (with one bin for all
other words), are compared with those of the whole language in the corpus by Jensen-Shannon distance (base 2, so
from 0 to 1). Minimum lengths guard both: a histogram of few characters or words says nothing and rejects nothing.

Results for odd input: a null or empty text has no words and fails the base rules; a document without a
language has no reference, so the base rules alone decide; equal rows get equal results; with no documents there are no references and no rows; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, released, staged

COMMON_WORDS = 32
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MIN_CHARS, MIN_COMMON = 200, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.42

SYMBOLS = r"[#*$%&|<>]"
#: Character classes that are counted; what is in none of them (mostly small a to z) is the last class.
CLASSES = {"upper": r"[A-Z]", "digit": r"[0-9]", "symbol": SYMBOLS, "stop": r"[.,;:]", "mark": r"""[\x21\x22\x27-\x29+\-/=?@\[-`{}~]""", "far": r"[^\x00-\x7F]", "space": r"[\x20\x09-\x0D]"}


def class_counts(text: Column) -> dict[str, Column]:
    """Characters of ``text`` in each class. What most texts are full of, small letters and white space, is taken out first, so that the other classes are looked for in the short rest."""
    rest = F.regexp_replace(text, "[a-z]++", "")
    bare = F.regexp_replace(rest, r"[\x20\x09-\x0D]++", "")
    n = {k: F.length(bare) - F.length(F.regexp_replace(bare, f"{p}++", "")) for k, p in CLASSES.items()} | {"space": F.length(rest) - F.length(bare)}
    return {k: c.cast("long").alias(f"c_{k}") for k, c in n.items()}


def shares(counts: list[Column], total: Column) -> Column:
    return F.array(*[F.coalesce(F.try_divide(c.cast("double"), total.cast("double")), F.lit(0.0)) for c in counts])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays that each sum to 1."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    each = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / 2))


def digest_of(text: Column, lang: Column) -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), lang)


def keyed(docs: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    """(id, lang, text, digest); id and digest tell rows apart, but for equal ones, whose results are equal."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"), digest_of(F.col(text_col), F.col(lang_col)).alias("digest"))


def measured(d: DataFrame) -> DataFrame:
    """One row per row of ``keyed``: words, base measures, and counts of character classes."""
    d = d.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select("id", "lang", "digest", "words", F.length("text").cast("long").alias("chars"), lines.alias("lines"), *class_counts(F.col("text")).values())
    d = d.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    triples = F.transform("h", lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)))
    d = d.withColumn("t", F.when(F.size("h") >= 3, F.slice(triples, 1, F.size("h") - 2)).otherwise(F.array().cast("array<bigint>")))
    # Positions of windows that occur again: neighbours in the sorted list of (window, position) with equal windows.
    again = F.size(F.array_distinct("t")) < F.size("t")
    d = d.withColumn("sorted", F.when(again, F.sort_array(F.transform("t", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    hit = F.transform("sorted", lambda s, i: F.when((s["x"] == F.when(i > 0, F.get("sorted", i - 1)["x"])) | (s["x"] == F.get("sorted", i + 1)["x"]), s["i"]))
    d = d.withColumn("at", F.sort_array(F.array_compact(hit)))
    covered = F.aggregate(F.transform("at", lambda a, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - a, F.lit(3)))), F.lit(0), lambda s, x: s + x)
    return d.select(
        "id", "lang", "digest", "chars",
        F.size("words").cast("long").alias("n_words"),
        (F.col("chars") - F.col("c_space")).alias("word_chars"),
        F.col("c_symbol").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        *[f"c_{k}" for k in CLASSES],
    )


def words_of(d: DataFrame) -> DataFrame:
    return d.where("lang IS NOT NULL").withColumn("word", F.explode(F.split("text", SPACE))).where("word <> ''").drop("text")


def common_words(d: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """(lang, word, place, share): the most common words of each language over all its documents, from place 0 on."""
    word = staged(words_of(d.select("lang", "text")).groupBy("lang", "word").agg(F.count("*").alias("n")), "language-words")
    total = staged(word.groupBy("lang").agg(F.sum("n").alias("words")), "language-totals")
    # The top of a language is the top of the tops of its shares, of which no task keeps more than the top rows.
    n = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("n"), "word"))
    top = word.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(256))).withColumn("k", n("part")).where(F.col("k") <= common)
    top = top.withColumn("place", n() - 1).where(F.col("place") < common)
    out = staged(top.join(broadcast_if_small(total), "lang").select("lang", "word", "place", (F.col("n") / F.col("words")).alias("share")), "common-words")
    released(word, total)
    return out


def word_shares(d: DataFrame, common: DataFrame) -> DataFrame:
    """(id, digest, n): for every row with words, a map from places of its language's common words, -1 for all other words, to how often they occur."""
    lists = common.select(F.xxhash64("lang", "word").alias("key"), "place")
    lists.staged_rows = common.staged_rows  # COMMON_WORDS rows a language
    lists = broadcast_if_small(lists)
    found = words_of(d).select("id", "digest", F.xxhash64("lang", "word").alias("key")).join(lists, "key", "left")
    counts = found.groupBy("id", "digest", F.coalesce("place", F.lit(-1)).alias("place")).agg(F.count("*").alias("n"))
    return counts.groupBy("id", "digest").agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("n"))


def with_rest(column: str) -> Column:
    """Shares with what they leave of 1 behind them."""
    return F.concat(column, F.array(1.0 - F.aggregate(column, F.lit(0.0), lambda s, x: s + x)))


def class_shares() -> Column:
    other = F.col("chars") - sum((F.col(f"c_{k}") for k in CLASSES), F.lit(0))
    return shares([*(F.col(f"c_{k}") for k in CLASSES), other], F.col("chars"))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """(id, digest, measures, class_distance, word_distance, base_failed, kept) for every row of ``docs``."""
    d = keyed(docs, text_col, lang_col, id_col)
    m = staged(measured(d), "measures")
    common = common_words(d)
    n = staged(word_shares(d, common).withColumnsRenamed({"id": "_id", "digest": "_digest"}), "word-shares")
    totals = m.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("chars").alias("chars"), *[F.sum(f"c_{k}").alias(f"c_{k}") for k in CLASSES])
    ref = common.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "share"))), lambda x: x["share"]).alias("q"))
    ref = ref.withColumn("q", with_rest("q"))
    refs = staged(totals.select("lang", class_shares().alias("class_ref")).join(ref, "lang", "left"), "language-references")
    m = m.join(broadcast_if_small(refs, 100_000), "lang", "left").join(n, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    all_words = F.aggregate(F.map_values("n"), F.lit(0).cast("long"), lambda s, x: s + x)
    p = F.transform(F.sequence(F.lit(0), F.size("q") - 2), lambda k: F.coalesce(F.try_element_at("n", k), F.lit(0)) / F.col("all_words"))
    m = m.withColumn("all_words", all_words).withColumn("p", F.when(F.col("n").isNotNull() & (F.size("q") > 1), p)).withColumn("p", with_rest("p"))
    m = m.withColumn("class_distance", F.when(F.col("chars") > 0, js_distance(class_shares(), F.col("class_ref"))))
    m = m.withColumn("word_distance", js_distance(F.col("p"), F.col("q")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    far = F.coalesce((F.col("chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE), F.lit(False)) | F.coalesce((F.col("n_words") >= MIN_COMMON) & (F.col("word_distance") > MAX_WORD_DISTANCE), F.lit(False))
    return m.select("id", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~far).alias("kept"), "class_distance", "word_distance")


def op2_divergence_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).withColumnRenamed("id", "doc_id").drop("digest", "class_distance", "word_distance")


_COUNTS = ", ".join(f"length(text) - length(regexp_replace(text, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')) AS c_{k}" for k, p in CLASSES.items())
_SHARES = ", ".join([*(f"sum(c_{k}) / nullif(sum(chars), 0)" for k in CLASSES), f"1.0::DOUBLE - sum({' + '.join(f'c_{k}' for k in CLASSES)}) / nullif(sum(chars), 0)"])
_TERM = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END + CASE WHEN {1} > 0 THEN {1} * log2(2 * {1} / ({0} + {1})) ELSE 0 END".format("p", "q")

SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, length(coalesce(text, '')) AS chars, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), c AS (SELECT doc_id, lang, chars, {_COUNTS} FROM d),
own AS (SELECT doc_id, lang, [{_SHARES}] AS p FROM c GROUP BY doc_id, lang),
ref AS (SELECT lang, [{_SHARES}] AS q FROM c WHERE lang IS NOT NULL GROUP BY lang),
far AS (
  SELECT doc_id, sqrt(greatest(0, sum({_TERM}) / 2)) AS class_distance
  FROM (SELECT doc_id, unnest(p) AS p, unnest(q) AS q FROM own JOIN ref ON own.lang = ref.lang) GROUP BY doc_id
), word AS (SELECT doc_id, lang, unnest(w) AS word FROM d),
count_of AS (SELECT doc_id, word, count(*) AS n FROM word GROUP BY doc_id, word),
lang_word AS (SELECT lang, word, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total FROM word WHERE lang IS NOT NULL GROUP BY lang, word),
top AS (SELECT lang, word, n / total AS q FROM lang_word QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {COMMON_WORDS}),
pair AS (SELECT d.doc_id, coalesce(n, 0) / len(w) AS p, q FROM d JOIN top ON d.lang = top.lang LEFT JOIN count_of k ON k.doc_id = d.doc_id AND k.word = top.word WHERE len(w) > 0),
all_pair AS (SELECT * FROM pair UNION ALL SELECT doc_id, 1 - sum(p), 1 - sum(q) FROM pair GROUP BY doc_id),
differ AS (SELECT doc_id, sqrt(greatest(0, sum({_TERM}) / 2)) AS word_distance FROM all_pair GROUP BY doc_id),
three AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, g FROM three GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM three JOIN twice USING (doc_id, g), (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, chars, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(c_symbol AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN (SELECT doc_id, c_symbol FROM c) USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(chars >= {MIN_CHARS} AND class_distance > {MAX_CLASS_DISTANCE}, false) AND NOT coalesce(n_words >= {MIN_COMMON} AND word_distance > {MAX_WORD_DISTANCE}, false) AS kept
FROM b LEFT JOIN far USING (doc_id) LEFT JOIN differ USING (doc_id)
"""
