"""English word stems by suffix stripping (Porter's algorithm), as column expressions for a table of distinct words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffixes of the published algorithm and what takes their place.
PLURALS = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DERIVED = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"),
           ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
           ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
FORMED = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
DROPPED = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def shape(word: Column) -> Column:
    """A letter per letter: V for vowels, C for consonants; y is a vowel behind a consonant."""
    marked = F.regexp_replace(F.regexp_replace(word, "[aeiou]", "V"), "^y", "C")
    return F.regexp_replace(F.regexp_replace(marked, "(?<=[^Vy])y", "V"), "[^V]", "C")


def measure(word: Column) -> Column:
    """How often a vowel is followed by a consonant."""
    return F.regexp_count(shape(word), F.lit("VC"))


def _has_vowel(word: Column) -> Column:
    return shape(word).contains("V")


def _short_end(word: Column) -> Column:
    """Ends consonant, vowel, consonant, the last no w, x or y."""
    return shape(word).endswith("CVC") & ~word.rlike("[wxy]$")


def _replaced(word: Column, rules, allowed) -> Column:
    """The longest suffix that fits decides: its replacement where the rest of the word is allowed, else the word."""
    out = None
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        rest = F.substring(word, F.lit(1), F.length(word) - len(suffix))
        result = F.when(allowed(suffix, rest), F.concat(rest, F.lit(new))).otherwise(word)
        out = F.when(word.endswith(suffix), result) if out is None else out.when(word.endswith(suffix), result)
    return out.otherwise(word)


def with_stem(words: DataFrame, word: str, name: str = "stem") -> DataFrame:
    """The table with the stem of each lower-case word.  Words of at most two letters are their own stem.  Every step is a column of its own, so
    that no step is spelled out again in the next."""
    w = F.col("__w")

    def step(df: DataFrame, made: Column) -> DataFrame:
        return df.withColumn("__w", F.when(F.length(word) > 2, made).otherwise(w))
    df = step(words.withColumn("__w", F.col(word)), _replaced(F.col(word), PLURALS, lambda s, rest: F.lit(True)))
    rest = F.regexp_extract(w, "^(.*?)(ed|ing)$", 1)
    df = df.withColumn("__cut", w.rlike("(ed|ing)$") & ~w.endswith("eed") & _has_vowel(rest))
    df = step(df, F.when(w.endswith("eed"), F.when(measure(F.regexp_replace(w, "eed$", "")) > 0, F.regexp_replace(w, "d$", "")).otherwise(w))
              .when(F.col("__cut"), rest).otherwise(w))
    mended = (F.when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
              .when(w.rlike(r"([^aeiouylsz])\1$"), F.regexp_replace(w, ".$", ""))
              .when((measure(w) == 1) & _short_end(w), F.concat(w, F.lit("e"))).otherwise(w))
    df = step(df, F.when(F.col("__cut"), mended).otherwise(w))
    df = step(df, F.when(w.endswith("y") & _has_vowel(F.regexp_replace(w, "y$", "")), F.regexp_replace(w, "y$", "i")).otherwise(w))
    df = step(df, _replaced(w, DERIVED, lambda s, rest: measure(rest) > 0))
    df = step(df, _replaced(w, FORMED, lambda s, rest: measure(rest) > 0))
    df = step(df, _replaced(w, [(s, "") for s in DROPPED], lambda s, rest: (measure(rest) > 1) & (rest.rlike("[st]$") if s == "ion" else F.lit(True))))
    bare = F.regexp_replace(w, "e$", "")
    df = step(df, F.when(w.endswith("e") & ((measure(bare) > 1) | ((measure(bare) == 1) & ~_short_end(bare))), bare).otherwise(w))
    df = step(df, F.when(w.endswith("ll") & (measure(F.regexp_replace(w, "l$", "")) > 1), F.regexp_replace(w, "l$", "")).otherwise(w))
    return df.withColumnRenamed("__w", name).drop("__cut")


def stems(spark, words: list[str]) -> dict[str, str]:
    """The stems of a few words."""
    if not words:
        return {}
    table = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
    return {r.word: r.stem for r in with_stem(table, "word").collect()}
