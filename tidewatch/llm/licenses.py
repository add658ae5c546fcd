"""License scans: a classifier over word n-grams, an unknown class, and template comparison.

A multinomial logistic regression with an L1 penalty is trained here on notices (built in and varied below) against paragraphs of the corpus, and
calibrated by a temperature that fits its held-out rows best.  Its few n-grams with a weight, and those of the templates, form a bounded table.

1. One pass splits every text into words that know their line, combines their hashes to 2- and 3-grams over line ends (not over lines without a
   letter or digit), and hands on those of the table only, with their places.
2. Where enough of a template stands close together, the stretch is scored; a notice is confirmed if the classifier names the template's family.  Of stretches that
   overlap the best stands, so neighbouring notices are told apart, wrapped or not.
3. Lines outside confirmed notices that read as a license alone, and else neighbouring lines that do together, are of the unknown class.

Everything is DataFrame and Spark ML work in the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Notices as their licences word them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "Released under the GNU GPL v3 or later."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the 3-clause BSD License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("public-domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0"),
)
#: Notices of no family above: examples of the unknown class.
UNKNOWN = (
    "Licensed under the terms that accompany this package.", "Use of this software is subject to the license agreement.",
    "This work is licensed under the Open Font License, version 1.1.", "Released under the zlib license.", "Licensed under the Community License, version 7.",
    "All rights reserved. No part of this publication may be reproduced without written permission of the publisher.",
    "This license grants you a limited, non-transferable right to use the product.", "Released under the Artistic License 2.0.",
    "Distributed under the Eclipse Public License, version 2.0.", "See the LICENSE file for the terms of use and redistribution.",
)
#: Sentences about licences that license nothing.
PLAIN = (
    "The driver's license was renewed in May.", "She lost her fishing license at the lake.", "A poetic license is granted to any writer.",
    "Permission to land was given at noon.", "The apache helicopter landed near the village.", "He studied at MIT and worked in public service.",
    "The general public was not admitted.", "Free of charge and open to any person.", "The terms of the treaty were signed in 1648.",
)
NONE, OTHER = "none", "unknown"


@dataclass(frozen=True)
class Training:
    """Bounds and thresholds.  ``paragraphs`` of the corpus at most are used as labelled rows of the class none; everything that is scored is
    scored whole."""

    paragraphs: int = 1500
    variants: int = 24
    vocabulary: int = 20_000
    penalty: float = 0.002
    probability: float = 0.6
    containment: float = 0.6
    temperatures: tuple[float, ...] = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def grams(words: Column, n: int) -> Column:
    """All n-grams as arrays of words; none if there are fewer words."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.slice(words, i, F.lit(n)))).otherwise(
        F.array().cast("array<array<string>>"))


def gram_key(gram: Column) -> Column:
    """The key of an array of two or three words: a hash of their hashes."""
    h = [F.xxhash64(F.get(gram, i)) for i in range(3)]
    return F.when(F.size(gram) == 2, F.xxhash64(h[0], h[1])).otherwise(F.xxhash64(*h))


def gram_keys(words: Column) -> Column:
    """Distinct keys of the 2- and 3-grams of a list of words."""
    return F.array_distinct(F.transform(F.concat(grams(words, 2), grams(words, 3)), gram_key))


def _listed(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    items = F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("notice")) for a, b in rows])
    return spark.range(1).select(F.explode(items).alias("r")).select("r.*")


def hits_of(docs: DataFrame, known: DataFrame, first_words: list[int]) -> DataFrame:
    """(row, doc_id, at, stop, line, last, key) of the known n-grams of all texts: words ``at`` to before ``stop``, from line ``line`` to line
    ``last``; ``row`` tells repeated documents apart.

    ``known`` has the keys and ``first_words`` the hashes of their first words; both are bounded and become part of the expression, so a
    text gives its few hits without being exploded.
    """
    keys = [r.key for r in known.select("key").collect()]
    if not keys:
        keys = first_words = [0]
    lines = F.split(F.lower(common.whole(F.col("text"))), "\n")
    words = F.flatten(F.transform(lines, lambda x, i: F.transform(tokens(x), lambda w: F.struct(i.alias("line"), F.xxhash64(w).alias("h")))))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    begins = f"filter(transform(words, (w, i) -> struct(i AS at, w.line AS line, w.h AS h)), x -> x.h IN ({', '.join(map(str, first_words))}))"
    rows = rows.withColumn("begins", F.expr(begins)).filter(F.size("begins") > 0)

    def gram(n: int) -> str:
        next_ones = [f"get(words, x.at + {i})" for i in range(1, n)]
        joined = " AND ".join(f"{b}.line - {a}.line <= 1" for a, b in zip(["x", *next_ones], next_ones))
        key = f"xxhash64(x.h, {', '.join(w + '.h' for w in next_ones)})"
        return f"transform(begins, x -> struct(x.at AS at, x.at + {n} AS stop, x.line AS line, {next_ones[-1]}.line AS last, IF({joined}, {key}, NULL) AS key))"
    hits = F.expr(f"filter(concat({gram(2)}, {gram(3)}), g -> g.key IN ({', '.join(map(str, keys))}))")
    return rows.select("row", "doc_id", F.explode(hits).alias("g")).select("row", "doc_id", "g.*")


def training_rows(docs: DataFrame, setting: Training) -> DataFrame:
    """(family, words, held_out): notices inside pieces of corpus text with a word left out now and then, and the pieces alone."""
    spark = docs.sparkSession
    # Whole paragraphs, taken by the order of their hashes; those that speak of licences are no examples of the class none.
    lines = docs.select(F.explode(F.split(F.lower(common.whole(F.col("text"))), "\n")).alias("line")).filter(F.length("line") > 30)
    plain = lines.orderBy(F.xxhash64("line"), "line").limit(setting.paragraphs).select(tokens(F.col("line")).alias("words"))
    plain = plain.filter(~F.array_join("words", " ").rlike("licen[sc]|copyright|warrant|redistribut|permission"))
    plain = cut_lineage(plain.select(F.row_number().over(_by_hash()).alias("n"), "words"))
    notices = _listed(spark, [*TEMPLATES, *((OTHER, t) for t in UNKNOWN), *((NONE, t) for t in PLAIN)])
    varied = notices.select("family", tokens(F.col("notice")).alias("notice"), F.explode(F.sequence(F.lit(0), F.lit(setting.variants - 1))).alias("v"))
    varied = varied.withColumn("n", F.pmod(F.xxhash64("notice", "v"), F.lit(max(1, setting.paragraphs))) + 1)
    varied = varied.join(plain.withColumnRenamed("words", "around"), "n", "left").withColumn("around", F.coalesce("around", F.array().cast("array<string>")))
    drop = F.pmod(F.xxhash64("v", "notice"), F.size("notice") * 2)
    kept = F.filter("notice", lambda w, i: (i != drop) | (F.col("v") == 0))
    side = F.col("v") % 3
    words = F.concat(F.when(side != 0, F.slice("around", 1, 12)).otherwise(F.array().cast("array<string>")), kept,
                     F.when(side == 2, F.slice("around", 13, 20)).otherwise(F.array().cast("array<string>")))
    return cut_lineage(varied.select("family", words.alias("words"), (F.col("v") % 4 == 1).alias("held_out")).unionByName(
        plain.select(F.lit(NONE).alias("family"), "words", (F.col("n") % 4 == 1).alias("held_out"))))


def _by_hash():
    return Window.orderBy(F.xxhash64("words"), "words")  # over the bounded sample


@dataclass
class Classifier:
    """``weights`` has key, the hash of the n-gram's first word, and a column w0, w1, ... per family; intercepts and families are in the same order."""

    families: list[str]
    weights: DataFrame
    intercepts: list[float]
    temperature: float


def trained(docs: DataFrame, setting: Training = Training()) -> Classifier:
    spark = docs.sparkSession
    rows = training_rows(docs, setting)
    names = sorted({f for f, _ in TEMPLATES}) + [OTHER, NONE]
    label = F.array_position(F.array(*map(F.lit, names)), F.col("family")).cast("double") - 1
    spelled = F.transform(F.concat(grams(F.col("words"), 2), grams(F.col("words"), 3)), lambda g: F.array_join(g, " "))
    rows = rows.select("words", "held_out", label.alias("label"), spelled.alias("grams"))
    fit = rows.filter("not held_out")
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=setting.vocabulary, minDF=2.0).fit(fit)
    model = LogisticRegression(maxIter=60, regParam=setting.penalty, elasticNetParam=1.0, family="multinomial", standardization=False).fit(counter.transform(fit))
    table = model.coefficientMatrix.toArray()
    used = abs(table).max(axis=0) > 1e-9
    kept = [(w, *map(float, table[:, i])) for i, w in enumerate(counter.vocabulary) if used[i]]
    columns = ", ".join(f"w{c} double" for c in range(len(names)))
    weights = spark.createDataFrame(kept, f"gram string, {columns}").withColumn("words", F.split("gram", " "))
    weights = weights.withColumns({"key": gram_key(F.col("words")), "first": F.xxhash64(F.get("words", 0))}).drop("gram", "words")
    classifier = Classifier(names, cut_lineage(weights), [float(x) for x in model.interceptVector], 1.0)
    held = rows.filter("held_out").select(F.monotonically_increasing_id().alias("row"), "label", "words")
    held = cut_lineage(held).select("row", "label", F.explode(gram_keys(F.col("words"))).alias("key"))
    scored = _scores(held, ["row", "label"], classifier)
    losses = scored.agg(*[F.avg(-F.log(F.greatest(F.element_at(_softmax(F.col("scores"), t), F.col("label").cast("int") + 1), F.lit(1e-12)))).alias(f"t{i}")
                          for i, t in enumerate(setting.temperatures)]).first()
    best = min(range(len(setting.temperatures)), key=lambda i: (losses[i] if losses[i] is not None else 0.0, i))
    classifier.temperature = setting.temperatures[best]
    return classifier


def _softmax(scores: Column, temperature: float) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp((s - top) / temperature))
    return common.bind(powers, lambda p: F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b)))


def template_grams(spark: SparkSession) -> DataFrame:
    """(t, key, first, n, words): the distinct n-grams of every template, with the hash of their first word, their number and that of its words."""
    rows = _listed(spark, [(str(i), text) for i, (_, text) in enumerate(TEMPLATES)])
    rows = rows.select(F.col("family").cast("int").alias("t"), tokens(F.col("notice")).alias("w"))
    every = F.array_distinct(F.transform(F.concat(grams(F.col("w"), 2), grams(F.col("w"), 3)),
                                         lambda g: F.struct(gram_key(g).alias("key"), F.xxhash64(F.get(g, 0)).alias("first"))))
    return rows.select("t", F.size("w").alias("words"), F.size(every).alias("n"), F.explode(every).alias("g")).select("t", "words", "n", "g.*")


def known_grams(classifier: Classifier) -> DataFrame:
    """(key, first, weights, shares): n-grams with a weight or in a template, the weights by family, and the share of each template that they make up."""
    grams_of = template_grams(classifier.weights.sparkSession)
    held = grams_of.groupBy("key", "first").agg(F.map_from_entries(F.collect_list(F.struct("t", (1 / F.col("n")).alias("share")))).alias("held"))
    weights = classifier.weights.select("key", "first", F.array(*[f"w{i}" for i in range(len(classifier.families))]).alias("weights"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(len(TEMPLATES) - 1)), lambda t: F.coalesce(F.try_element_at("held", t), F.lit(0.0)))
    none = F.array_repeat(F.lit(0.0), len(classifier.families))
    return cut_lineage(weights.join(held, ["key", "first"], "full").select("key", "first", F.coalesce("weights", none).alias("weights"), shares.alias("shares")))


def _scores(hits: DataFrame, keys: list[str], classifier: Classifier, known: DataFrame | None = None) -> DataFrame:
    """For rows with equal ``keys`` and their distinct n-grams (key): family scores, and the share of each template's n-grams they hold.

    The joined table has a row per n-gram with a weight or in a template: at most the vocabulary bound and the templates' own.
    """
    known = known_grams(classifier) if known is None else known

    def total(begin: list[float], part: str) -> Column:
        return F.aggregate("held", F.array(*map(F.lit, begin)), lambda acc, x: F.zip_with(acc, x[part], lambda a, b: a + b)).alias({"weights": "scores"}.get(part, part))
    held = hits.select(*keys, "key").distinct().join(F.broadcast(known.drop("first")), "key").groupBy(*keys).agg(
        F.collect_list(F.struct("weights", "shares")).alias("held"))
    return held.select(*keys, total(classifier.intercepts, "weights"), total([0.0] * len(TEMPLATES), "shares"))


def _judged(hits: DataFrame, keys: list[str], classifier: Classifier, known: DataFrame) -> DataFrame:
    """``keys`` with guess, probability, and the share of the guess's best template."""
    names = F.array(*map(F.lit, classifier.families))
    owners = F.array(*[F.lit(f) for f, _ in TEMPLATES])
    rows = _scores(hits, keys, classifier, known).withColumn("p", _softmax(F.col("scores"), classifier.temperature))
    rows = rows.withColumn("probability", F.array_max("p")).withColumn("guess", F.element_at(names, F.array_position("p", F.col("probability")).cast("int")))
    share = F.array_max(F.zip_with("shares", owners, lambda s, f: F.when(f == F.col("guess"), s).otherwise(0.0)))
    return rows.select(*keys, "guess", "probability", share.alias("template_share"))


def stretches(hits: DataFrame, setting: Training) -> DataFrame:
    """(row, doc_id, at, stop, line, last, t): where enough of template ``t`` stands within a quarter more words than it has; of those that overlap the
    one with the largest share, then of the longest template."""
    spark = hits.sparkSession
    most = max(len(re.findall("[a-z0-9]+", text.lower())) for _, text in TEMPLATES) * 5 // 4
    rows = hits.join(F.broadcast(template_grams(spark).drop("first")), "key")
    ahead = Window.partitionBy("row", "t").orderBy("at").rangeBetween(0, most)
    rows = rows.withColumn("near", F.collect_list(F.struct("at", "stop", "last", "key")).over(ahead))
    rows = rows.withColumn("near", F.filter("near", lambda x: x["stop"] <= F.col("at") + F.col("words") * 5 / 4))
    rows = rows.withColumn("share", F.size(F.array_distinct(F.col("near.key"))) / F.col("n")).filter(F.col("share") >= setting.containment)
    # The stretch ends where each n-gram has been there once; what follows may be the next notice.
    rows = rows.withColumn("near", F.filter("near", lambda x, i: ~F.exists(F.slice("near", F.lit(1), i), lambda y: y["key"] == x["key"])))
    rows = rows.select("row", "doc_id", "at", "line", "t", "words", "share", F.array_max("near.stop").alias("stop"), F.array_max("near.last").alias("last"))
    rank = F.struct("share", (F.col("at") - F.col("stop")).alias("tight"), (-F.col("at")).alias("before"))
    around = Window.partitionBy("row", "t").orderBy("at").rangeBetween(-most, most)
    rows = rows.withColumn("rank", rank)
    rows = rows.withColumn("around", F.collect_list(F.struct("rank", "at", "stop")).over(around)).filter(
        ~F.exists("around", lambda y: (y["at"] < F.col("stop")) & (F.col("at") < y["stop"]) & (y["rank"] > F.col("rank"))))
    one = F.struct("share", "words", "rank", "t", "at", "stop", "line", "last")
    lists = rows.groupBy("row", "doc_id").agg(F.sort_array(F.collect_set(one), asc=False).alias("all"))
    # The notices of one text; the list of those that stand grows with them only.
    stand = F.aggregate("all", F.slice("all", 1, 0), lambda acc, x: F.when(
        F.exists(acc, lambda y: (y["at"] < x["stop"]) & (x["at"] < y["stop"])), acc).otherwise(F.concat(acc, F.array(x))))
    return lists.select("row", "doc_id", F.explode(stand).alias("s")).select("row", "doc_id", "s.at", "s.stop", "s.line", "s.last", "s.t")


def found(docs: DataFrame, classifier: Classifier, setting: Training = Training()) -> DataFrame:
    """(doc_id, paragraph, family, probability, template_share): every notice of a family at its first line, and as ``unknown`` what else reads as a license:
    lines alone, or neighbouring lines together, at the first one, where none of them does alone.  A line that a notice of a family touches is not
    reported again.

    ``docs`` has doc_id and text; further columns are ignored.  Null and empty texts have no two words and no row; documents with a null doc_id are
    reported under null, repeated ones as often; lines count from 0; an empty table gives no rows.
    """
    known = known_grams(classifier)
    first_words = [r["first"] for r in known.select("first").distinct().collect()]  # as bounded as the table
    hits = cut_lineage(hits_of(docs, known, first_words))
    families = F.array(*[F.lit(f) for f, _ in TEMPLATES])

    notices = cut_lineage(stretches(hits, setting))
    place = ["row", "doc_id", "line", "last", "n_at", "t"]
    inside = notices.withColumnRenamed("at", "n_at").withColumnRenamed("stop", "n_stop").join(hits.select("row", "at", "stop", "key"), "row")
    inside = inside.filter("at >= n_at and stop <= n_stop")
    sure = _judged(inside, place, classifier, known)
    sure = cut_lineage(sure.filter((F.col("guess") == F.element_at(families, F.col("t") + 1)) & (F.col("probability") >= setting.probability)))

    covered = sure.select(F.col("row").alias("__row"), F.col("line").alias("__line"), F.col("last").alias("__last"))
    free = cut_lineage(hits.join(covered, (F.col("row") == F.col("__row")) & (F.col("line") <= F.col("__last")) & (F.col("last") >= F.col("__line")), "left_anti"))
    lines = _judged(free.filter("line = last"), ["row", "doc_id", "line"], classifier, known).filter(F.col("guess") != NONE)
    by_line = Window.partitionBy("row").orderBy("line")
    islands = free.select("row", "line").union(free.select("row", F.col("last").alias("line"))).distinct()
    islands = islands.withColumn("new", (F.col("line") - F.lag("line").over(by_line) > 1).cast("int"))
    islands = islands.withColumn("island", F.coalesce(F.sum("new").over(by_line), F.lit(0)))
    islands = cut_lineage(islands.withColumn("begin", F.min("line").over(Window.partitionBy("row", "island"))).select("row", "line", "begin"))
    together = _judged(free.join(islands, ["row", "line"]), ["row", "doc_id", "begin"], classifier, known).filter(F.col("guess") != NONE)
    told = lines.select("row", "line").join(islands, ["row", "line"]).select("row", "begin").distinct()
    together = together.join(told, ["row", "begin"], "left_anti").withColumnRenamed("begin", "line")

    columns = ["doc_id", "line", "guess", "probability", "template_share"]
    other = lines.select(columns).unionByName(together.select(columns)).withColumn("guess", F.lit(OTHER))
    return sure.select(columns).unionByName(other).select(
        "doc_id", F.col("line").alias("paragraph"), F.col("guess").alias("family"), F.round("probability", 6).alias("probability"),
        F.round("template_share", 6).alias("template_share"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return found(docs, trained(docs))
