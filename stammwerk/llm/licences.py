"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs (lines) become sparse hashed word n-grams (pairs). A multinomial logistic regression,
fitted on variations of licence notices and on a bounded sample of the corpus' own
paragraphs as the class ``unknown``, names a licence family. A probability threshold is
calibrated on all other paragraphs of the corpus, each text once, so that few unknown ones pass;
what passes is confirmed if it holds most n-grams of one of the family's notices. All of it is
DataFrame functions and Spark's own regression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.llm.shared import hashed_share, stored

UNKNOWN = "unknown"
FEATURES = 1 << 13
# Paragraphs of the corpus the unknown class is fitted on.
SAMPLE_PARAGRAPHS = 3000
# Share of the corpus' different unknown paragraphs that may pass as a licence.
FALSE_SHARE = 0.001
# Probabilities are counted in so many steps to find the threshold.
PROBABILITY_STEPS = 10_000
LEAST_PROBABILITY = 0.5
CONFIRMED_SHARE = 0.8

# Notices by licence family, as their licences or customs word them.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ],
    "cc0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights"
        " to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this publication may be reproduced without"
        " prior written permission.",
    ],
}


@dataclass
class LicenceModel:
    regression: LogisticRegressionModel
    families: list[str]  # by class number; UNKNOWN is one of them
    threshold: float


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams_of(words: Column) -> Column:
    """Pairs of neighbouring words."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def paragraphs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, paragraph, text) of every line that is not blank."""
    lines = docs.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.posexplode(F.split(F.col(text_column), "\r\n|\n|\r")).alias("paragraph", "text"),
    )
    return lines.where(F.trim("text") != "")


def notices(spark: SparkSession) -> DataFrame:
    """(family, notice, text) of the built-in notices."""
    rows = [
        F.struct(F.lit(family).alias("family"), F.lit(k).alias("notice"), F.lit(text).alias("text"))
        for family, texts in NOTICES.items()
        for k, text in enumerate(texts)
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("n")).select("n.*")


def _hashed(rows: DataFrame) -> DataFrame:
    tf = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    return tf.transform(rows.withColumn("grams", grams_of(F.col("words"))))


def _variations(known: DataFrame) -> DataFrame:
    """Each notice whole, without some words at either end, and with strange words around it."""
    words = words_of(F.col("text"))
    whole = known.select("family", words.alias("words"))
    cuts = F.explode(F.expr("sequence(0, least(3, greatest(0, size(words) - 4)))"))
    trimmed = whole.withColumn("cut", cuts)
    from_left = trimmed.select("family", F.expr("slice(words, cut + 1, size(words))").alias("words"))
    from_right = trimmed.select("family", F.expr("slice(words, 1, size(words) - cut)").alias("words"))
    around = whole.crossJoin(known.sparkSession.range(4)).select(
        "family",
        F.expr("concat(array(concat('left', id), concat('lead', id)), words,"
               " array(concat('right', id)))").alias("words"),
    )
    return from_left.union(from_right).union(around)


def template_grams(spark: SparkSession) -> dict[str, list[list[str]]]:
    """The different word pairs of each family's notices."""
    grams = grams_of(words_of(F.col("text")))
    found: dict[str, list[list[str]]] = {family: [] for family in NOTICES}
    # One row per built-in notice.
    for row in notices(spark).select("family", F.array_distinct(grams).alias("grams")).collect():
        found[row.family].append(row.grams)
    return found


def _coverage(templates: list[list[str]], grams: Column) -> Column:
    """The largest share of one template's pairs that is in ``grams``."""
    shares = [
        F.size(F.array_intersect(F.lit(wanted), grams)) / F.lit(len(wanted)) for wanted in templates
    ]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def _sampled(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """About ``size`` paragraphs chosen by a hash of their text, each text once.

    They come from about ``4 * size`` documents, chosen by a hash of theirs.
    """
    some = docs.where(hashed_share(F.xxhash64(text_column), docs.count(), 4 * size))
    texts = paragraphs(some, id_column, text_column).select(
        "text", F.xxhash64("text").alias("chosen_by")
    )
    chosen = texts.distinct().orderBy("chosen_by", "text").limit(2 * size)
    return chosen.where(F.pmod(F.xxhash64("chosen_by"), F.lit(2)) == 0)


def _fit(
    docs: DataFrame, id_column: str, text_column: str, sample_paragraphs: int
) -> tuple[LicenceModel, DataFrame]:
    """The regression, not yet calibrated, and the hashes of the paragraphs it was fitted on."""
    spark = docs.sparkSession
    families = [UNKNOWN, *NOTICES]
    number = F.create_map(*[F.lit(x) for k, f in enumerate(families) for x in (f, float(k))])
    known = _hashed(_variations(notices(spark))).select(
        number[F.col("family")].alias("label"), "features"
    )
    sample = _sampled(docs, id_column, text_column, sample_paragraphs)
    hashed = _hashed(sample.withColumn("words", words_of(F.col("text"))))
    # A sampled paragraph that holds a notice is no example of the unknown.
    hashed = hashed.where(_coverage(_every_template(spark), F.col("grams")) < CONFIRMED_SHARE)
    # Both are a few thousand rows, read many times: few files, not one per shuffle partition.
    unknown = stored(
        hashed.select(F.lit(0.0).alias("label"), "features", "chosen_by").coalesce(1),
        "unknown-paragraphs",
    )
    training = stored(
        known.union(unknown.select("label", "features")).coalesce(1), "licence-training"
    )
    regression = LogisticRegression(
        family="multinomial", maxIter=60, regParam=1e-4, tol=1e-5
    ).fit(training)
    return LicenceModel(regression, families, LEAST_PROBABILITY), unknown.select("chosen_by")


def _every_template(spark: SparkSession) -> list[list[str]]:
    return [grams for templates in template_grams(spark).values() for grams in templates]


def _candidates(docs: DataFrame, model: LicenceModel, id_column: str, text_column: str) -> DataFrame:
    """The paragraphs that are no less likely a licence than the model's threshold says."""
    rows = _hashed(
        paragraphs(docs, id_column, text_column).withColumn("words", words_of(F.col("text")))
    )
    predicted = model.regression.transform(rows.select("doc_id", "paragraph", "text", "grams", "features"))
    names = F.array(*[F.lit(f) for f in model.families])
    spark = docs.sparkSession
    share = F.coalesce(*[
        F.when(F.col("family") == family, _coverage(templates, F.col("grams")))
        for family, templates in template_grams(spark).items()
    ])
    return (
        predicted.withColumn("probability", vector_to_array("probability"))
        .withColumn("licence", F.lit(1.0) - F.col("probability")[0])
        .where(F.col("licence") >= model.threshold)
        .withColumn("family", names[F.col("prediction").cast("int")])
        .select(
            "doc_id", "paragraph", "family",
            F.col("probability")[F.col("prediction").cast("int")].alias("probability"),
            "licence", share.alias("template_share"),
            _coverage(_every_template(spark), F.col("grams")).alias("any_share"), "text",
        )
    )


def _threshold(
    docs: DataFrame, candidates: DataFrame, fitted: DataFrame, false_share: float,
    id_column: str, text_column: str,
) -> float:
    """The least probability that at most ``false_share`` of the unknown paragraphs reach.

    All paragraphs count, each text once, but those that hold a notice or were fitted on. Those
    below ``LEAST_PROBABILITY`` need only be counted.
    """
    text = F.xxhash64("text").alias("chosen_by")
    every = paragraphs(docs, id_column, text_column).select(text).distinct()
    different = every.join(F.broadcast(fitted), "chosen_by", "left_anti").count()
    step = F.floor(F.col("licence") * PROBABILITY_STEPS).alias("step")
    holds = (F.col("any_share") >= CONFIRMED_SHARE).alias("holds")
    steps = (
        candidates.select(text, step, holds).distinct()
        .join(F.broadcast(fitted), "chosen_by", "left_anti")
        .groupBy("step", "holds").count().collect()  # two rows a step at most
    )
    unknown = different - sum(r["count"] for r in steps if r.holds)
    passing = 0
    for r in sorted((r for r in steps if not r.holds), key=lambda r: -r.step):
        passing += r["count"]
        if passing > false_share * unknown:
            return max(LEAST_PROBABILITY, (r.step + 1) / PROBABILITY_STEPS)
    return LEAST_PROBABILITY


def train(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    sample_paragraphs: int = SAMPLE_PARAGRAPHS, false_share: float = FALSE_SHARE,
) -> LicenceModel:
    """Fit on the notices and about ``sample_paragraphs`` paragraphs, calibrate on all others."""
    model, fitted = _fit(docs, id_column, text_column, sample_paragraphs)
    found = stored(_candidates(docs, model, id_column, text_column), "licence-candidates")
    least = _threshold(docs, found, fitted, false_share, id_column, text_column)
    return LicenceModel(model.regression, model.families, least)


def scan_licences(
    docs: DataFrame,
    model: LicenceModel | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_paragraphs: int = SAMPLE_PARAGRAPHS,
) -> DataFrame:
    """Licence notices in whole texts, one row per paragraph that a notice was found in.

    Returns (doc_id, paragraph, family, probability, template_share, confirmed, notice):
    the paragraph's number from 0 by line, the predicted family and its probability,
    the share of the best notice's word pairs found, whether that confirms the family,
    and the paragraph. Paragraphs the model calls unknown, or that it
    is less sure of than its calibrated threshold, are left out. Null and empty texts have no
    paragraphs; repeated rows are listed as often as they occur, rows without an id
    with a null id. Other columns play no part; an empty table gives an empty result.
    """
    if model is None:
        fresh, fitted = _fit(docs, id_column, text_column, sample_paragraphs)
        found = stored(_candidates(docs, fresh, id_column, text_column), "licence-candidates")
        least = _threshold(docs, found, fitted, FALSE_SHARE, id_column, text_column)
    else:
        found, least = _candidates(docs, model, id_column, text_column), model.threshold
    return found.where((F.col("family") != UNKNOWN) & (F.col("licence") >= least)).select(
        "doc_id", "paragraph", "family", "probability", "template_share",
        (F.col("template_share") >= CONFIRMED_SHARE).alias("confirmed"),
        F.col("text").alias("notice"),
    )
