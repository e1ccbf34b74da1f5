"""License scans: a trained paragraph classifier, confirmed against templates.

Paragraphs (lines) are classified into licence families or "unknown" by multinomial logistic
regression with an L1 penalty over word n-grams.  It is trained here, on the templates, on damaged
forms of them, on look-alikes and on a bounded sample of corpus lines, and the softness of its
probabilities is set on training rows it was not fitted on.  A family stands if its probability is
high enough; it is confirmed if a template of the family is found in the paragraph.

Features are the word n-grams of the templates and look-alikes, but those of function words alone.  A
paragraph without any that has a coefficient is predicted as the empty paragraph is, "unknown" (checked
after training), so that only paragraphs with a word of such an n-gram need be scored.  All of it is
DataFrame functions and Spark ML.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.sources import materialize

UNKNOWN = "unknown"

# Usual notices of licence families.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License v3.0.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX: Apache-2.0.",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution 4.0 International.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0 International.",
        "CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Creative Commons Attribution-ShareAlike 4.0 International.",
        "CC BY-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Distributed under the terms of the GNU GPL v3.",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Lesser General Public License v2.1.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "mpl": (
        "This work is licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain.",
        "To the extent possible under law, the author has waived all copyright under the CC0 1.0 public domain dedication.",
    ),
}

# Sentences with the same words that license nothing.
LOOKALIKES = (
    "The driver showed a license to the officer.",
    "Her fishing license expired last week.",
    "Members have rights and duties under the statute.",
    "He asked for permission to leave the room.",
    "The license plate was stolen.",
    "Human rights are the subject of this course.",
    "The public asked for a redistribution of land.",
    "The court discussed copyright in music.",
    "A table was reserved under the name of the host.",
    "The domain of the function is open to the public.",
)

#: Corpus lines with one of these are not taken as examples of "unknown".
STEMS = ("licen", "copyright", "rights", "permission", "redistribut", "domain")

_N = 3


def words_of(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def has_stem(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for stem in STEMS:
        found = found | low.contains(stem)
    return found


def _runs(words: Column, n: int) -> Column:
    """All runs of n words, none if there are fewer."""
    last = F.size(words) - n + 1
    return F.when(
        last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(words, i, n)))
    ).otherwise(F.array().cast("array<string>"))


def ngrams(words: Column) -> Column:
    """Runs of 1 to 3 words."""
    return F.array_distinct(F.concat(*[_runs(words, n) for n in range(1, _N + 1)]))


def shingles(words: Column) -> Column:
    """Runs of five words, or the whole if it has fewer."""
    return F.array_distinct(F.when(F.size(words) >= 5, _runs(words, 5)).otherwise(F.array(F.concat_ws(" ", words))))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("family"), F.lit(t).alias("text")) for k, ts in TEMPLATES.items() for t in ts]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def _threes(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return [" ".join(words[i : i + _N]) for i in range(len(words) - _N + 1)]


def training_rows(spark: SparkSession, corpus_lines: DataFrame, max_corpus_rows: int) -> DataFrame:
    """(family, words): templates whole, with each word left out, and cut to four fifths or more;
    look-alikes; and of at most ``max_corpus_rows`` corpus lines without a stem, by a hash of the line, those
    without three words of a template in a row."""
    base = _templates(spark).select("family", words_of(F.col("text")).alias("words"))
    n = F.size("words")
    whole = base.select("family", F.explode(F.array_repeat("words", 12)).alias("words"))
    holes = base.select(
        "family",
        F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.filter("words", lambda w, j: j != i - 1))).alias("words"),
    )
    cuts = base.select(
        "family", F.explode(F.transform(F.sequence(F.ceil(n * 0.8).cast("int"), n), lambda k: F.slice("words", 1, k))).alias("words")
    )
    odd = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in LOOKALIKES])).alias("line"))
    odd = odd.select(F.lit(UNKNOWN).alias("family"), F.explode(F.array_repeat(words_of(F.col("line")), 8)).alias("words"))
    plain = (
        corpus_lines.filter(~has_stem(F.col("line")))
        .orderBy(F.xxhash64("line"), "line")
        .limit(max_corpus_rows)
        .select(F.lit(UNKNOWN).alias("family"), words_of(F.col("line")).alias("words"))
    )
    # Written first, so that runs are cut from words that stand, not split from the line for each run.
    own = sorted({run for ts in TEMPLATES.values() for t in ts for run in _threes(t)})
    shared = F.arrays_overlap(_runs(F.col("words"), _N), F.array(*[F.lit(x) for x in own]))
    plain = materialize(plain, label="license-plain").filter(~shared)
    return whole.unionByName(holes).unionByName(cuts).unionByName(odd).unionByName(plain)


@dataclass
class Classifier:
    vectors: CountVectorizerModel
    model: LogisticRegressionModel
    families: list[str]
    softness: float
    least: float

    def may_have_features(self, words: Column) -> Column:
        """False only where no n-gram of ``words`` has a coefficient other than zero."""
        weights = self.model.coefficientMatrix.toArray()
        terms = [t.split(" ") for t, w in zip(self.vectors.vocabulary, weights.T) if w.any()]
        common = _function_words()
        # All words of an n-gram stand in a paragraph that holds it, so one of them is enough to look for.
        keys: set[str] = set()
        for term in sorted(terms, key=lambda t: (len(t), t)):
            if not keys & set(term):
                keys.add(max(term, key=lambda w: (w not in common, len(w), w)))
        return F.exists(words, lambda w: w.isin(sorted(keys))) if keys else F.lit(False)

    def classify(self, rows: DataFrame) -> DataFrame:
        """``rows`` (words, ...) with family and probability; below ``least`` the family is unknown."""
        raw = self.logits(rows)
        top = F.array_max("logits")
        best = F.get(F.array(*[F.lit(f) for f in self.families]), F.array_position("logits", top).cast("int") - 1)
        return raw.withColumn("probability", 1.0 / _mass(self.softness)).withColumn(
            "family", F.when(F.col("probability") >= self.least, best).otherwise(F.lit(UNKNOWN))
        ).drop("logits")

    def logits(self, rows: DataFrame) -> DataFrame:
        """``rows`` (words, ...) with the array of the families' logits, written down: what follows
        refers to them many times, and each time would run the model again."""
        made = self.model.transform(self.vectors.transform(rows.withColumn("terms", ngrams(F.col("words")))))
        return materialize(made.select(*rows.columns, vector_to_array("rawPrediction").alias("logits")), label="license-logits")


def _mass(softness: float) -> Column:
    """The sum of the families' odds against the best one."""
    odds = F.transform("logits", lambda x: F.exp((x - F.array_max("logits")) / F.lit(softness)))
    return F.aggregate(odds, F.lit(0.0), lambda s, x: s + x)


def _function_words() -> set[str]:
    """English stop words, as words_of splits them, and single letters and digits."""
    stops = {part for w in StopWordsRemover.loadDefaultStopWords("english") for part in re.findall("[a-z0-9]+", w)}
    return stops | set("abcdefghijklmnopqrstuvwxyz0123456789")


def train(spark: SparkSession, corpus_lines: DataFrame, *, max_corpus_rows: int = 500, least: float = 0.6) -> Classifier:
    """Fit on two thirds of the training rows, set the softness on the rest."""
    families = sorted([*TEMPLATES, UNKNOWN])
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("truth")).cast("double") - 1
    rows = training_rows(spark, corpus_lines, max_corpus_rows).withColumnRenamed("family", "truth").withColumn("label", label)
    # A few hundred short rows: one partition, so that each step of the fit is one task.
    rows = materialize(rows.withColumn("terms", ngrams(F.col("words"))).coalesce(1), label="license-training")
    # Terms of the templates and look-alikes only, a constant of this module.
    known = _templates(spark).select(words_of(F.col("text")).alias("words"))
    odd = spark.range(1).select(F.explode(F.array(*[words_of(F.lit(t)) for t in LOOKALIKES])).alias("words"))
    terms = known.unionByName(odd).select(F.explode(ngrams(F.col("words"))).alias("term")).distinct().orderBy("term")
    common = _function_words()
    vectors = CountVectorizerModel.from_vocabulary(
        [r.term for r in terms.collect() if not set(r.term.split(" ")) <= common], inputCol="terms", outputCol="features", minTF=1.0, binary=True
    )
    rest = F.pmod(F.xxhash64("words", "truth"), F.lit(3)) == 0
    learner = LogisticRegression(
        family="multinomial", regParam=0.0001, elasticNetParam=0.5, maxIter=30, tol=1e-4, labelCol="label", probabilityCol="scaled"
    )
    model = learner.fit(vectors.transform(rows.filter(~rest | (F.size("terms") == 0))))
    made = Classifier(vectors, model, families, 1.0, least)
    held = made.logits(rows.filter(rest).select("words", "label"))

    def loss(t: float) -> Column:
        own = F.get("logits", F.col("label").cast("int")) - F.array_max("logits")
        return F.coalesce(F.avg(F.log(_mass(t)) - own / F.lit(t)), F.lit(0.0))

    steps = [0.5, 0.7, 1.0, 1.4, 2.0]
    losses = held.agg(*[loss(t).alias(f"t{k}") for k, t in enumerate(steps)]).first()
    made.softness = min(zip(losses, steps))[1]
    empty = made.classify(spark.range(1).select(F.array().cast("array<string>").alias("words"))).first()
    if empty.family != UNKNOWN:
        raise RuntimeError("a paragraph without features must be unknown")
    return made


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, words) of all lines."""
    lines = F.transform(F.split("text", "\n"), words_of)
    return docs.select("doc_id", F.posexplode(lines).alias("line_no", "words"))


def _likeness(template: Column, words: Column) -> Column:
    """The share of a template's shingles among those of ``words``; 1 if its words stand in a run."""
    run = F.concat(F.lit(" "), F.concat_ws(" ", template["words"]), F.lit(" "))
    inside = F.concat(F.lit(" "), F.concat_ws(" ", words), F.lit(" ")).contains(run)
    return F.when(inside, 1.0).otherwise(F.size(F.array_intersect(template["parts"], shingles(words))) / F.size(template["parts"]))


def scan(docs: DataFrame, classifier: Classifier | None = None, *, confirm: float = 0.8) -> DataFrame:
    """One row per paragraph that is taken for a licence: doc_id, line_no, family, probability,
    likeness (the best share of a template's five-word shingles found in it) and confirmed.

    Null and empty texts have no such paragraph; texts of any length are scanned whole; rows that
    share a doc_id are scanned each.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    if classifier is None:
        first_lines = docs.select(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("line")).filter("line <> ''")
        classifier = train(spark, first_lines)
    lines = lines_of(docs).filter(classifier.may_have_features(F.col("words")))
    found = classifier.classify(lines).filter(F.col("family") != UNKNOWN)
    # All templates of a family beside the paragraph: the table of templates is a constant of this module.
    known = _templates(spark).select(F.col("family").alias("of"), words_of(F.col("text")).alias("words"))
    known = known.withColumn("parts", shingles(F.col("words"))).groupBy("of").agg(F.collect_list(F.struct("words", "parts")).alias("templates"))
    best = F.array_max(F.transform("templates", lambda t: _likeness(t, F.col("words"))))
    return found.join(F.broadcast(known), F.col("family") == F.col("of")).withColumn("likeness", best).select(
        "doc_id", "line_no", "family", "probability", "likeness", (F.col("likeness") >= confirm).alias("confirmed")
    )


def document_licenses(docs: DataFrame, **options) -> DataFrame:
    """One row per doc_id: n_paragraphs, families (of confirmed paragraphs, sorted) and n_unconfirmed."""
    ids = docs.select(
        "doc_id", F.when(F.length("text") > 0, F.length("text") - F.length(F.translate("text", "\n", "")) + 1).otherwise(0).alias("n")
    )
    found = scan(docs, **options).groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.sum((~F.col("confirmed")).cast("long")).alias("n_unconfirmed"),
    )
    ids = ids.groupBy("doc_id").agg(F.sum("n").cast("long").alias("n_paragraphs"))
    of = found.withColumnRenamed("doc_id", "of")
    return ids.join(of, F.col("doc_id").eqNullSafe(F.col("of")), "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_unconfirmed", F.lit(0).cast("long")).alias("n_unconfirmed"),
    )
