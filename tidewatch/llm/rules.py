"""Quality rules, line first: lines that fail a rule go, then documents that lost too much text.

Everything happens inside the row, so nothing is shuffled and every task's memory is bounded by its longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: A document that loses a larger share of its words' characters is rejected.
MAX_LOST_PERCENT = 50

SYMBOLS = r"[#*$%&|<>]"
#: Lines with more symbols than that are markup, tables or noise.
MAX_SYMBOL_PERCENT = 5
#: Shorter lines must end like a sentence.
FRAGMENT_WORDS = 8
SENTENCE_END = r"[.!?:;,\x{2026}\"'\x{201D}\x{00BB})\]\x{3002}][\x20\x09-\x0D]*$"
NAVIGATION = (r"(?:[|\x{00BB}\x{203A}\x{00B7}\x{2022}].*){3}|(?i:^[\x20\x09-\x0D]*(?:home|menu|search|login|log in|sign in|sign up|next|previous|"
              r"back to top|skip to content|share|tweet|print|read more|contact us|about us|site map)[\x20\x09-\x0D]*$)")
BOILERPLATE = (r"(?i:all rights reserved|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)|we use cookies|accept cookies|"
               r"enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|click here to|page not found)")


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS + "+", ""))


def _covered(grams: Column) -> Column:
    """Words in windows found twice: windows sorted by hash find their equals as neighbours, then interval lengths are added up in text order."""
    def spread(tagged: Column) -> Column:
        again = F.filter(tagged, lambda x, j: F.coalesce(F.get(tagged, j - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(tagged, j + 1)["h"] == x["h"], F.lit(False)))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))
        step = F.aggregate(F.sort_array(F.transform(again, lambda x: x["i"])), start, lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["words"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("words")))
        return step["words"]
    return common.bind(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), spread)


def repeated_words(w: Column) -> Column:
    """Words in windows of eight found twice or more; windows are compared by 64-bit hashes within one text."""
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
    found = common.bind(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_covered(g)))
    return F.when(F.size(w) <= WINDOW, 0).otherwise(found)


def line_passes(line: Column) -> Column:
    """The rules of one line with a word: not mostly symbols, no navigation, no boilerplate, a sentence end if it is short."""
    few = F.size(F.split(F.trim(line), common.SPACE)) < FRAGMENT_WORDS
    return ((_symbols(line) * 100 <= F.length(line) * MAX_SYMBOL_PERCENT) & ~line.rlike(NAVIGATION) & ~line.rlike(BOILERPLATE)
            & (line.rlike(SENTENCE_END) | ~few))


def judged(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text, clean_chars and kept.

    ``clean_text`` has the lines that pass (a line repeated in the text counts as boilerplate after its first place; lines without words stay).
    Null texts count as empty: no words, base_failed, not kept.  Rows are judged one by one, so repeated rows get the same answer
    twice, an empty table gives no rows, and input columns named like a result are replaced.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "clean_chars", "kept"]
    keep = common.fresh(docs, *own)
    text = common.whole(F.col("text"))
    by_word = common.bind(common.words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        repeated_words(w).cast("bigint").alias("n_repeat_words")))

    def by_line(lines: Column) -> Column:
        full = F.filter(lines, lambda x: x.rlike(common.WORD))
        return common.bind(full, lambda f: F.struct(
            (F.size(f) - F.size(F.array_distinct(f))).cast("bigint").alias("n_dup_lines"),
            F.array_join(F.filter(F.when(F.size(f) == F.size(F.array_distinct(f)), lines).otherwise(_first_places(lines)),
                                  lambda x: ~x.rlike(common.WORD) | line_passes(x)), "\n").alias("clean_text")))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), by_word.alias("w"),
                       _symbols(text).cast("bigint").alias("n_symbols"), common.bind(F.split(text, "\n"), by_line).alias("l"))
    rows = rows.select("row", "w.*", "n_symbols", "l.*")
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT))
    rows = rows.withColumn("clean_chars", F.length(F.regexp_replace("clean_text", common.SPACE, "")).cast("bigint"))
    kept = ~F.col("base_failed") & ((F.col("word_chars") - F.col("clean_chars")) * 100 <= F.col("word_chars") * MAX_LOST_PERCENT)
    return rows.withColumn("kept", kept).select("row.*", *own)


def _first_places(lines: Column) -> Column:
    """Lines with words at their first place only, and all lines without."""
    tagged = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def firsts(t: Column) -> Column:
        first = F.filter(t, lambda a, j: ~F.coalesce(F.get(t, j - 1)["x"] == a["x"], F.lit(False)) | ~a["x"].rlike(common.WORD))
        return F.transform(F.sort_array(F.transform(first, lambda a: F.struct(a["i"].alias("i"), a["x"].alias("x")))), lambda a: a["x"])
    return common.bind(F.sort_array(tagged), firsts)


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed; ``n_chars``, where there is one, follows the text."""
    done = judged(docs).filter("kept").withColumn("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS lines FROM docs),
grams AS (
    SELECT rid, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS gram
    FROM worded WHERE len(w) >= 8),
again AS (
    SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1),
covered AS (
    SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM again) GROUP BY rid),
lines AS (
    SELECT rid, unnest(range(len(lines))) AS i, unnest(lines) AS line FROM worded),
full_lines AS (
    SELECT *, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS nth FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
by_line AS (
    SELECT rid, count(*) FILTER (nth > 1) AS n_dup_lines,
           sum(len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (nth = 1
               AND (len(line) - len(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) * 100 <= len(line) * 5
               AND NOT regexp_matches(line, '""" + NAVIGATION.replace("'", "''") + r"""')
               AND NOT regexp_matches(line, '""" + BOILERPLATE.replace("'", "''") + r"""')
               AND (regexp_matches(line, '""" + SENTENCE_END.replace("'", "''") + r"""')
                    OR len(regexp_split_to_array(trim(line), '[\x20\x09-\x0D]+')) >= 8)) AS clean_chars
    FROM full_lines GROUP BY rid),
counted AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(clean_chars, 0) AS BIGINT) AS clean_chars
    FROM worded d LEFT JOIN by_line USING (rid) LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (word_chars - clean_chars) <= 50 * word_chars AS kept
FROM counted
"""
