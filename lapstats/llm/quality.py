"""Line-first quality rules (operator 4), with DataFrame functions only.

Every line that has a word is judged by four rules; lines that fail any are removed:

* punctuation: the line does not end a sentence (``ENDS``);
* navigation: two or more separators of menus and breadcrumbs (``SEPARATORS``);
* boilerplate: a phrase of page furniture (``FURNITURE``);
* symbols: more than one character in ``SYMBOL_SHARE`` is a mark-up symbol.

A document is rejected when its base rules fail (too few words, too many words in repeated
eight-word windows) or when more than ``MAX_LOSS`` percent of the characters of its lines
are removed. All of it is a map over rows: no shuffle, so no group can be hot.

Windows are compared by 64-bit hashes within one document. Defined cases: null and empty
texts have no words and are rejected; rows are judged each by itself, so repeated rows and
null ids change nothing; helper columns carry
a prefix of their own (``P``), other columns stay; result columns of the same name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30        # percent of words
MAX_LOSS = 40            # percent of the characters of lines
SYMBOL_SHARE = 20
SYMBOLS = "[#*$%&|<>]"
ENDS = r"""[.!?:;…。！？]["'”’»)\]]*[ \t\x0b\f\r]*$"""
SEPARATORS = r"[|›»•→].*[|›»•→]"
FURNITURE = (r"(cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|"
             r"lorem ipsum|click here|read more|sign up for|subscribe now|share this|back to top)")
HAS_WORD = r"[^ \t\n\x0b\f\r]"
P = "_quality_rules_4_"


def line_fails(line: Column) -> Column:
    """Whether one line fails a rule."""
    return (~line.rlike(ENDS) | line.rlike(SEPARATORS) | F.lower(line).rlike(FURNITURE)
            | (F.regexp_count(line, F.lit(SYMBOLS)) * SYMBOL_SHARE > F.length(line)))


def _pairwise(arr: Column, step: int, n: Column) -> Column:
    """Hash of the elements i and i + step, for every i that has both."""
    return F.zip_with(F.slice(arr, F.lit(1), n - step), F.slice(arr, F.lit(1 + step), n - step),
                      lambda a, b: F.xxhash64(a, b))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept and cleaned (the text of the lines that pass). Columns of those names are replaced."""
    c = lambda name: F.col(P + name)
    flat = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(P + "text", flat)
    for ch in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(ch), F.lit(" "))
    out = out.withColumn(P + "words", F.array_remove(F.split(flat, " "), ""))
    out = out.withColumn(P + "n", F.size(c("words")))
    out = out.withColumn(P + "lines", F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(HAS_WORD)))
    out = out.withColumn(P + "good", F.filter(c("lines"), lambda x: ~line_fails(x)))
    # hashes of eight-word windows by doubling: 1, 2, 4, 8 words
    long = c("n") >= WINDOW
    out = out.withColumn(P + "h1", F.when(long, F.transform(c("words"), lambda w: F.xxhash64(w))))
    out = out.withColumn(P + "h2", F.when(long, _pairwise(c("h1"), 1, c("n"))))
    out = out.withColumn(P + "h4", F.when(long, _pairwise(c("h2"), 2, c("n") - 1)))
    out = out.withColumn(P + "h8", F.when(long, _pairwise(c("h4"), 4, c("n") - 3)))
    out = out.withColumn(P + "some", long & (F.size(F.array_distinct(c("h8"))) < F.size(c("h8"))))
    # only where a window comes twice: sort (hash, place) and keep places beside an equal hash
    out = out.withColumn(P + "sorted", F.when(c("some"), F.sort_array(
        F.transform(c("h8"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn(P + "hs", F.when(c("some"), F.transform(c("sorted"), lambda x: x["h"])))
    out = out.withColumn(P + "before", F.when(c("some"), F.zip_with(
        c("sorted"), F.concat(F.array(F.lit(None).cast("long")), F.slice(c("hs"), 1, F.size(c("hs")) - 1)),
        lambda x, h: F.struct(x["h"].alias("h"), x["i"].alias("i"), h.eqNullSafe(x["h"]).alias("d")))))
    out = out.withColumn(P + "starts", F.when(c("some"), F.sort_array(F.array_compact(F.zip_with(
        c("before"), F.slice(c("hs"), 2, F.size(c("hs"))),
        lambda x, h: F.when(x["d"] | h.eqNullSafe(x["h"]), x["i"]))))))
    covered = F.aggregate(
        F.zip_with(c("starts"), F.slice(c("starts"), 2, F.size(c("starts"))),
                   lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0), lambda s, x: s + x)
    out = out.withColumns({
        "n_words": c("n").cast("long"),
        "word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
        "n_symbols": F.regexp_count(c("text"), F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        "n_repeat_words": F.when(c("some"), covered).otherwise(F.lit(0)).cast("long"),
        P + "all_chars": F.length(F.array_join(c("lines"), "")),
        P + "good_chars": F.length(F.array_join(c("good"), "")),
        "cleaned": F.array_join(c("good"), "\n"),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed")
                         & (100 * c("good_chars") >= (100 - MAX_LOSS) * c("all_chars")))
    made = ("text", "words", "n", "lines", "good", "h1", "h2", "h4", "h8", "some", "sorted", "hs", "before", "starts",
            "all_chars", "good_chars")
    return out.drop(*[P + x for x in made])


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op4_quality_rules(spark, sf_dir) -> DataFrame:
    return measure(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(*RESULT)


def clean(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Pipeline stage: rejected documents go, failing lines go from the others."""
    # a filter on ``kept`` would be pushed below the measures and repeat them all; an
    # empty array drops the row where it stands
    keep = F.explode(F.when(F.col("kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    kept = measure(docs).withColumn(P + "keep", keep)
    return kept.withColumns({"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}).select(*docs.columns)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_quoted(HAS_WORD)})) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS s
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
twice AS (SELECT doc_id, s FROM win GROUP BY 1, 2 HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win JOIN twice USING (doc_id, s), range({WINDOW}) r(k) GROUP BY 1),
g AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, {_quoted(ENDS)}) AND NOT regexp_matches(x, {_quoted(SEPARATORS)})
          AND NOT regexp_matches(lower(x), {_quoted(FURNITURE)})
          AND len(regexp_extract_all(x, '{SYMBOLS}')) * {SYMBOL_SHARE} <= length(x)) AS good FROM w),
m AS (SELECT g.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             length(array_to_string(lines, '')) AS all_chars, length(array_to_string(good, '')) AS good_chars
      FROM g LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * good_chars >= {100 - MAX_LOSS} * all_chars AS kept FROM b
"""
