"""Fill-in-middle: texts are cut into units, and two hashed places make a prefix, a middle and a suffix of them.

A unit grammar says between which characters a unit ends: after some classes of characters and before another. It is
translated to a regular expression of zero width that looks at these neighbours only, so that Spark's ``split`` cuts
there and every piece keeps all its characters; joined, the pieces are the text. All of it is DataFrame functions,
without a shuffle: a document's places and form depend on its id alone.

Results for odd input: a null or empty text has no units and stays plain, as the empty text; so does one that holds a
sentinel, which could not be told apart; a text of one unit has an empty prefix, middle or suffix; a null id is hashed
as an empty one; equal rows get equal results; texts of any length are cut whole; no documents give no rows; extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED, SENTINELS = 7, ("<P>", "<S>", "<M>")
SPACE_CLASS, OTHER_CLASS = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: Any character; not the second half of one that takes two places in Java's strings.
ANY_CLASS = r"[^\x{DC00}-\x{DFFF}]"


@dataclass(frozen=True)
class Grammar:
    """A unit ends behind characters of the classes ``behind``, one after another, where one of ``before`` follows."""

    behind: tuple[str, ...]
    before: str

    def boundary(self) -> str:
        return f"(?<={''.join(self.behind)})(?={self.before})"


GRAMMARS = {
    "line": Grammar((r"\n",), r"[\s\S]"),  # [^\n]*\n|[^\n]+
    "paragraph": Grammar((r"\n", r"\n"), r"[^\n]"),
    "sentence": Grammar((r"[.!?]", SPACE_CLASS), OTHER_CLASS),
    "word": Grammar((SPACE_CLASS,), OTHER_CLASS),  # a word with the white space behind it
    "character": Grammar((r"[\s\S]",), ANY_CLASS),
}


def units_of(text: Column, units: str) -> Column:
    """The units of a text, which split has as one empty unit where there is no text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, GRAMMARS[units].boundary(), -1))


def digits(hashed: Column, k: int) -> Column:
    """The ``k``-th group of eight hexadecimal digits (from 0) as a number."""
    return F.conv(F.substring(hashed, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, units: str = "line", share: int = 100, spm_share: int = 50, seed: int = SEED, sentinels: tuple[str, str, str] = SENTINELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix, middle, suffix, output) for every row; ``share`` percent are transformed, of these ``spm_share`` percent with the suffix first.

    Of plain rows the output is the text and the parts are null.
    """
    p, s, m = (F.lit(x) for x in sentinels)
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("units", units_of(F.col("text"), units)).withColumn("n", F.size("units").cast("long"))
    d = d.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256))
    h = [digits(F.col("hash"), k) for k in range(4)]
    places = [h[k] % (F.col("n") + 1) for k in (0, 1)]
    d = d.withColumn("low", F.least(*places).cast("int")).withColumn("high", F.greatest(*places).cast("int"))
    held = F.contains("text", p) | F.contains("text", s) | F.contains("text", m)
    form = F.when((F.col("text") == "") | held | (h[2] % 100 >= share), "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm")
    d = d.withColumn("form", form)
    part = lambda start, n: F.when(F.col("form") != "plain", F.array_join(F.slice("units", start + 1, n), ""))
    d = d.select(
        "id", "n", "form", "text", part(F.lit(0), F.col("low")).alias("prefix"), part(F.col("low"), F.col("high") - F.col("low")).alias("middle"), part(F.col("high"), F.col("n").cast("int") - F.col("high")).alias("suffix"),
    )
    psm, spm = F.concat(p, "prefix", s, "suffix", m, "middle"), F.concat(s, "suffix", p, "prefix", m, "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return d.withColumn("output", output).drop("text")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text again, from what was made of it and its form alone."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in sentinels), -1)  # what stands before the first sentinel is empty
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    d = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    chars = lambda c: F.length(c).cast("long")
    return d.select(
        "doc_id", "n", "form", chars(F.col("prefix")).alias("prefix_chars"), chars(F.col("middle")).alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM d),
c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (SELECT *, array_to_string(u[1:low], '') AS prefix, array_to_string(u[low + 1:high], '') AS middle, array_to_string(u[high + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""
