"""Licence scan: a trained paragraph classifier, confirmed by templates. JVM work only.

A paragraph is what stands between lines without words (wrapped lines are joined); a line in it that
has enough of a template by itself is a paragraph of its own. Its lower-cased words and word pairs are counted against a
vocabulary taken from licence templates, and a multinomial logistic regression gives
each family, and the class ``unknown``, a probability. It is trained on the templates, on cuts of them, and
on a bounded sample of paragraphs of the corpus as ``unknown``.

A prediction counts only if a template of the predicted family confirms it: enough of the template's
word pairs are in the paragraph, or enough of the paragraph's (``least_pairs`` or more) in the template. Single
lines of a joined paragraph are scored too, since a notice may stand in the middle of other text; they count if
the joined lines are no licence. Paragraphs that a template of any family confirms are no examples of unknown text:
they are left out of the background and of the calibration.

The unknown class is calibrated on all other paragraphs of the corpus: a family must be likelier than
``unknown_quantile`` of them are for any family (the rank is exact to 1 in 100,000).

Defined results: NULL and empty texts have no paragraphs and no licence; a paragraph without
any word of a template is unknown and counts as such in the calibration; rows that share a doc_id are one document, and each
of them gets its row; a family counts once in a paragraph; no rows give no rows; other columns are not read. Texts of any length
are cut into their paragraphs whole. Without any corpus paragraph the threshold is one half.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.llm.common import stage
from shelftide.llm.labelled_sample import sample_ids, with_texts

UNKNOWN = "unknown"

# Wordings of public licence notices, by family. Families that differ by a word are families of their own.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2 or any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPLv3. Licensed under the GPL, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Released under the Simplified BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "CC0": (
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-SA-4.0",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-ND-4.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
}


@dataclass(frozen=True)
class LicenseParams:
    """``background`` bounds the sampled documents; one line of each is trained on."""

    background: int = 2000
    unknown_quantile: float = 0.999
    least_probability: float = 0.5
    confirmed_share: float = 0.6
    least_pairs: int = 8
    iterations: int = 60
    ridge: float = 1e-3


@dataclass
class LicenseModel:
    vocabulary: CountVectorizerModel
    regression: LogisticRegressionModel
    families: list[str]
    threshold: float


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^0-9a-z]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.when(
        F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    ).otherwise(F.array().cast("array<string>"))


def _template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def _template_pairs(text: str) -> list[str]:
    words = _template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


_TEXTS = [text for texts in TEMPLATES.values() for text in texts]
KNOWN_WORDS = sorted({w for text in _TEXTS for w in _template_words(text)})
KNOWN_PAIRS = sorted({g for text in _TEXTS for g in _template_pairs(text)})


# Words of a piece of a long template.
PIECE = 10


def _own_words() -> list[str]:
    """The words that templates of one family alone have."""
    holders: dict[str, set[str]] = {}
    for family, texts in TEMPLATES.items():
        for word in {w for text in texts for w in _template_words(text)}:
            holders.setdefault(word, set()).add(family)
    return sorted(w for w, families in holders.items() if len(families) == 1)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used: in an array of one."""
    return F.transform(F.array(value), use)[0]


def _known(words: Column, params: LicenseParams) -> Column:
    """``grams``: the distinct words and word pairs that templates have; ``mine``: the pairs among them; ``n_pairs``: the number of
    all distinct pairs, where ``mine`` are enough for that to matter. Pairs are formed only where two known words are."""
    none = F.array().cast("array<string>")

    def found(mine: Column, known: Column) -> Column:
        n_pairs = F.when(F.size(mine) >= params.least_pairs, F.size(F.array_distinct(_pairs(words)))).otherwise(0)
        return F.struct(mine.alias("mine"), n_pairs.alias("n_pairs"), F.concat(known, mine).alias("grams"))

    def pairs(known: Column) -> Column:
        mine = F.when(F.size(known) > 1, F.filter(F.array_distinct(_pairs(words)), lambda g: g.isin(KNOWN_PAIRS))).otherwise(none)
        return _once(mine, lambda m: found(m, known))

    return _once(F.array_distinct(F.filter(words, lambda w: w.isin(KNOWN_WORDS))), pairs)


def _confirmed_families(known: Column, params: LicenseParams, as_part: bool = True) -> Column:
    """The families with a template that confirms a paragraph of these ``_known`` pairs; with ``as_part``
    False only those whose template is in the paragraph, not the other way round."""
    listed = [(family, _template_pairs(text)) for family, texts in TEMPLATES.items() for text in texts]
    templates = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*map(F.lit, t)).alias("pairs")) for f, t in listed])
    least = min(params.confirmed_share * len(t) for _, t in listed)

    def confirms(t: Column) -> Column:
        common = F.size(F.array_intersect(known["mine"], t["pairs"]))
        whole = common / F.size(t["pairs"]) >= params.confirmed_share
        return whole | ((common >= params.least_pairs) & (common >= params.confirmed_share * known["n_pairs"])) if as_part else whole

    families = F.array_distinct(F.transform(F.filter(templates, confirms), lambda t: t["family"]))
    return F.when(F.size(known["mine"]) >= min(least, params.least_pairs), families).otherwise(F.array().cast("array<string>"))


def _templates(spark: SparkSession) -> DataFrame:
    """The templates as rows, written into the plan: one row of literals, exploded."""
    rows = [F.struct(F.lit(family).alias("family"), F.lit(text).alias("paragraph")) for family, texts in TEMPLATES.items() for text in texts]
    listed = spark.range(1).select(F.explode(F.array(*rows)).alias("t"))
    return listed.select("t.family", _words(F.col("t.paragraph")).alias("words"))


# Kinds of scored text: a line with a template of its own, the joined other lines of a paragraph, one of these.
OWN, JOINED, PART = 0, 1, 2


def _paragraphs(docs: DataFrame, params: LicenseParams, id_col: str, text_col: str) -> DataFrame:
    """doc_id, block (stretches between lines without words, from 0), kind, paragraph, known, others: the lines and paragraphs
    with a word of a template. ``others`` counts those of the block without any, which all have the same probabilities; a
    block of none else has one row without ``known``."""
    # Cut before every line without words, so that one stretch ends there.
    blocks = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n(?=[^0-9A-Za-z\n]*(?:\n|$))")).alias("block", "stretch"))
    lines = F.filter(F.split("stretch", "\n"), lambda x: F.trim(x) != "")

    def described(kind: Column, text: Column, words: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("paragraph"), words.alias("words"), _known(words, params).alias("known"))

    def line(text: Column) -> Column:
        def placed(part: Column) -> Column:
            own = F.size(_confirmed_families(part["known"], params, as_part=False)) > 0
            return part.withField("kind", F.when(own, F.lit(OWN)).otherwise(F.lit(PART)))

        return _once(_once(_words(text), lambda w: described(F.lit(PART), text, w)), placed)

    def joined(rest: Column) -> Column:
        words = F.flatten(F.transform(rest, lambda x: x["words"]))
        text = F.array_join(F.transform(rest, lambda x: x["paragraph"]), "\n")
        alone = F.transform(rest, lambda x: x.withField("kind", F.lit(JOINED)))
        return F.when(F.size(rest) > 1, F.concat(rest, F.transform(F.array(words), lambda w: described(F.lit(JOINED), text, w)))).otherwise(alone)

    def all_of(each: Column) -> Column:
        rest = F.filter(each, lambda x: x["kind"] == PART)
        return F.concat(F.filter(each, lambda x: x["kind"] == OWN), F.flatten(F.transform(F.array(rest), joined)))

    units = F.flatten(F.transform(F.array(F.transform(lines, line)), all_of))
    slim = lambda u: F.struct(u["kind"].alias("kind"), u["paragraph"].alias("paragraph"), u["known"].alias("known"))
    kept = lambda all_units: F.transform(F.filter(all_units, lambda u: F.size(u["known"]["grams"]) > 0), slim)
    split = _once(units, lambda x: F.struct(kept(x).alias("kept"), F.size(x).alias("n")))
    rows = blocks.select("doc_id", "block", split.alias("s")).select("doc_id", "block", F.col("s.n").alias("n"), F.col("s.kept").alias("kept"))
    rows = rows.select("doc_id", "block", (F.col("n") - F.size("kept")).alias("missing"), F.posexplode_outer("kept").alias("at", "u"))
    others = F.when(F.coalesce("at", F.lit(0)) == 0, F.col("missing")).otherwise(0)
    return rows.select("doc_id", "block", "u.kind", "u.paragraph", "u.known", others.alias("others"))


def _fit(docs: DataFrame, params: LicenseParams, id_col: str, text_col: str) -> LicenseModel:
    """The model before its calibration."""
    spark = docs.sparkSession
    templates = _templates(spark)
    # Cuts: every template without each one of its words, so single words decide less. Words of one family alone stay, and
    # what is left must not be the template of another family.
    own_words = _own_words()
    at = F.element_at("words", F.col("k"))
    cuts = templates.select("family", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("k"), "words").where(~at.isin(own_words))
    cuts = cuts.select("family", F.concat(F.slice("words", F.lit(1), F.col("k") - 1), F.slice("words", F.col("k") + 1, F.size("words"))).alias("words"))
    cuts = cuts.join(F.broadcast(templates.select("words")), "words", "left_anti").select("family", "words")
    # Pieces of long templates, as wrapped lines show them.
    long = templates.where(F.size("words") > 2 * PIECE).select("family", F.explode(F.expr(f"sequence(1, size(words) - {PIECE}, {PIECE} div 2)")).alias("k"), "words")
    pieces = long.select("family", F.slice("words", F.col("k"), F.lit(PIECE)).alias("words"))
    known = templates.unionByName(cuts).unionByName(pieces).where(F.size("words") > 0)
    # Which documents are sampled depends on a hash of their id; one paragraph of each, by a hash too.
    chosen = with_texts(sample_ids(docs.select(id_col), id_col, params.background), docs, id_col, text_col)
    lines = F.filter(F.split(F.col("data").cast("string"), "\n"), lambda x: F.trim(x) != "")
    picked = chosen.select("sample_id", lines.alias("lines")).where(F.size("lines") > 0)
    one = picked.select(
        _words(F.element_at("lines", (F.pmod(F.xxhash64("sample_id", F.lit(2)), F.size("lines")) + 1).cast("int"))).alias("words"),
    )
    # A sampled paragraph that a template confirms is no example of unknown text.
    facts = one.select(_known(F.col("words"), params).alias("known"))
    background = stage(facts.where(F.size(_confirmed_families(F.col("known"), params)) == 0).select("known.grams"), "background")

    vocabulary = CountVectorizerModel.from_vocabulary([*KNOWN_WORDS, *KNOWN_PAIRS], inputCol="grams", outputCol="counts", binary=True)
    families = [*TEMPLATES, UNKNOWN]
    label = F.element_at(F.create_map(*[x for k, f in enumerate(families) for x in (F.lit(f), F.lit(float(k)))]), F.col("family"))
    known = known.select("family", _known(F.col("words"), params)["grams"].alias("grams"))
    examples = known.unionByName(background.select(F.lit(UNKNOWN).alias("family"), "grams"))
    examples = vocabulary.transform(examples.select(label.alias("label"), "grams"))
    regression = LogisticRegression(featuresCol="counts", family="multinomial", regParam=params.ridge, maxIter=params.iterations).fit(examples)
    return LicenseModel(vocabulary, regression, families, params.least_probability)


def _scored(docs: DataFrame, model: LicenseModel, params: LicenseParams, id_col: str, text_col: str) -> DataFrame:
    """One row per paragraph with a word of a template: the predicted family, the probability of the likeliest family, and
    the families that a template confirms. Place and text are there only for those with one. ``others`` counts the
    paragraphs beside; ``scored`` is false for rows that stand for those alone."""
    rows = _paragraphs(docs, params, id_col, text_col)
    rows = rows.withColumn("grams", F.coalesce("known.grams", F.array().cast("array<string>")))
    scored = model.regression.transform(model.vocabulary.transform(rows)).withColumn("p", vector_to_array("probability"))
    names = F.array(*[F.lit(f) for f in model.families])
    family = F.element_at(names, F.col("prediction").cast("int") + 1)
    likeliest = F.array_max(F.slice("p", 1, len(model.families) - 1))
    none = F.array().cast("array<string>")
    confirmed = F.coalesce(_confirmed_families(F.col("known"), params), none).alias("confirmed")
    rows = scored.select("doc_id", "block", "kind", "paragraph", "others", F.col("known").isNotNull().alias("scored"), family.alias("family"), likeliest.alias("probability"), confirmed)
    shown = F.size("confirmed") > 0
    return rows.select(*[F.when(shown, F.col(c)).alias(c) for c in ("doc_id", "block", "kind", "paragraph")], "others", "scored", "family", "probability", "confirmed")


def _calibrated(scored: DataFrame, model: LicenseModel, params: LicenseParams) -> LicenseModel:
    """The model with the threshold from all paragraphs that no template confirms. Paragraphs without any word of a
    template have the model's constant; they are counted, and the rank among the rest follows."""
    if model.regression.numClasses < len(model.families):
        return model
    unknown = F.col("scored") & (F.size("confirmed") == 0)
    counts = scored.agg(F.count_if(unknown).alias("some"), F.sum("others").alias("others")).first()
    some, everything = counts["some"], counts["some"] + (counts["others"] or 0)
    # The rank that counts is this far from the upper end, whatever lies below.
    share = 1 - (1 - params.unknown_quantile) * everything / some if some else 0.0
    intercepts = model.regression.interceptVector.toArray()
    weights = [math.exp(x - max(intercepts)) for x in intercepts]
    quantile = max(weights[:-1]) / sum(weights)
    if share > 0:
        quantile = scored.where(unknown).agg(F.percentile_approx("probability", share, 100_000)).first()[0]
    return replace(model, threshold=max(params.least_probability, quantile))


def _accepted(scored: DataFrame, model: LicenseModel) -> DataFrame:
    """One row per paragraph and family. Single lines count only if the joined ones are no licence."""
    accepted = F.array_contains("confirmed", F.col("family")) & (F.col("probability") > model.threshold)
    best = F.max(F.struct("probability", "paragraph")).alias("best")
    rows = scored.where(accepted).groupBy("doc_id", "block", "family", "kind").agg(best)
    blocks = rows.groupBy("doc_id", "block").agg(F.collect_list(F.struct("kind", "family", "best")).alias("found"))
    whole = F.exists("found", lambda x: x["kind"] == JOINED)
    counted = F.filter("found", lambda x: ~whole | (x["kind"] != PART))
    each = blocks.select("doc_id", "block", F.explode(counted).alias("f")).groupBy("doc_id", "block", F.col("f.family").alias("family"))
    return each.agg(F.max("f.best").alias("best")).select("doc_id", "block", "best.paragraph", "family", "best.probability")


def train(docs: DataFrame, params: LicenseParams = LicenseParams(), id_col: str = "doc_id", text_col: str = "text") -> LicenseModel:
    model = _fit(docs, params, id_col, text_col)
    return _calibrated(_scored(docs, model, params, id_col, text_col), model, params)


def scan(
    docs: DataFrame, model: LicenseModel, params: LicenseParams = LicenseParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Licence paragraphs: doc_id, block (stretches between lines without words, from 0), paragraph, family, probability."""
    return _accepted(_scored(docs, model, params, id_col, text_col), model)


def scan_documents(docs: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """One row per document: doc_id, families (sorted, comma-joined, empty for none) and
    n_license_paragraphs. Only found paragraphs are shuffled. The scores are staged: they are read for the
    threshold and again for the verdict, and paragraphs are scored once."""
    model = _fit(docs, params, "doc_id", "text")
    scored = stage(_scored(docs, model, params, "doc_id", "text"), "license_scores")
    found = _accepted(scored, _calibrated(scored, model, params))
    grouped = found.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.count("family").alias("n_license_paragraphs")
    )
    ids = docs.select("doc_id")
    joined = ids.join(grouped.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return joined.select("doc_id", F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_license_paragraphs", F.lit(0)).alias("n_license_paragraphs"))
