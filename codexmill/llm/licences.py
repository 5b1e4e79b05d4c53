"""Licence scans, in Spark expressions and Spark ML only.

A sparse logistic regression over word n-grams tells licence families apart, paragraph by paragraph; it
learns from the notices below, whole and in pieces, against paragraphs of the corpus and sentences that
only speak of licences (the unknown class). A temperature calibrates its probabilities, from notices
and wordings that the model fitted for it hasn't seen, with all their pieces and copies. A prediction is confirmed if its words are those of one of the family's notices, or if it
is a part of one: most of its words, three at least and two of them distinctive, are in that notice and in no other family's as many.
Wrapped notices are put together from neighbouring lines. Short statements, in four languages, are confirmed
by a name of the family and few words but those that such statements are made of, or by a name that is no
word of a language (`GPLv3`, `CC BY 4.0`, `MIT` in capitals) beside a word of licensing. Every line that
can be confirmed at all is scored: it must have a word of the notices that isn't common, or such a name.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.llm.common import bounded_sample, cut, small, text_hash

UNKNOWN = "unknown"

# Notices of licence families in common use.
NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE in the project root for license information.",
        "This project is available under the terms of the MIT License (MIT).",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This file is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GPLv3. SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Released under the LGPL.",
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Released under the AGPLv3.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the authors have waived all copyright and related or neighboring rights to this work under the CC0 Public Domain Dedication.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright Example Corporation. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# Short names of the families, and the ways to say in four languages that a text is under one.
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0", "Apache License 2.0"],
    "BSD": ["BSD", "BSD-3-Clause", "BSD-2-Clause"],
    "ISC": ["ISC"],
    "GPL-2.0": ["GPL-2.0", "GPLv2", "GNU GPL v2", "GPL version 2", "GPL-2.0-only", "GPL-2.0-or-later"],
    "GPL-3.0": ["GPL-3.0", "GPLv3", "GNU GPL v3", "GPL version 3", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL", "LGPLv3", "LGPL-2.1", "LGPL-3.0-or-later"],
    "AGPL-3.0": ["AGPL", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License 2.0"],
    "CC-BY": ["CC-BY", "CC-BY-4.0", "CC BY 3.0", "Creative Commons Attribution"],
    "CC-BY-SA": ["CC-BY-SA", "CC-BY-SA-4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike"],
    "CC-BY-NC": ["CC-BY-NC", "CC-BY-NC-4.0", "CC-BY-NC-SA", "CC-BY-NC-ND", "Creative Commons Attribution-NonCommercial"],
    "CC-BY-ND": ["CC-BY-ND", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives"],
    "CC0": ["CC0", "CC0-1.0"],
    "Unlicense": ["Unlicense"],
}
FORMS = [
    "Available under {}.", "Released under {}.", "Licensed under {}.", "Distributed under the {} license.", "Published under the terms of the {} licence.", "License: {}", "SPDX-License-Identifier: {}",
    "Veröffentlicht unter der {}-Lizenz.", "Lizenziert unter {}.", "Dieses Werk steht unter der {} Lizenz.", "Lizenz: {}",
    "Publié sous licence {}.", "Distribué sous la licence {}.", "Sous licence {}.", "Licence : {}",
    "Publicado bajo la licencia {}.", "Distribuido bajo licencia {}.", "Bajo la licencia {}.", "Licencia: {}",
    "{}", "Code: {}", "SPDX: {}", "Released under the {} terms.", "Everything here is under {}.", "{} licensed",
]
# Words by which a statement says that something is under the licence that it names.
UNDER = "as licence licences licenced license licenses licensed licensing lizenz lizenziert licencia licenciado licencié under unter sous bajo term terms".split()
# Sentences with licence words that state no licence of a text.
MENTIONS = [
    "He lost his driving license on the way to the court.",
    "The restaurant was refused a licence to sell wine.",
    "The council granted permission to build the bridge.",
    "A permission slip has to be signed by a parent.",
    "They argued about copyright for years.",
    "The warranty covers parts and labour for two years.",
    "Her fishing licence expires in May.",
    "The bill on copyright reform was sent back to the committee.",
    "With your permission I would like to begin.",
    "The redistribution of land took a decade.",
    "Licensed drivers only beyond this point.",
    "The agency licensed the drug for use in children.",
    "Which license should I choose for my project?",
    "The old songs have been in the public domain since 1950, some say.",
    "Creative people often work in common rooms.",
    "She explained how GPLv3 differs from its predecessor in court.",
    "The committee discussed Apache 2.0 and CC BY for an hour.",
]
#: One notice, wording or paragraph of so many is kept for the temperature.
HELD = 4
#: Paragraphs with one of these (lower-cased) speak of licences: `unknown` if no prediction is confirmed. Which are scored doesn't depend on them.
CUES = ["licen", "copyright", "permission", "redistribut", "public domain", "rights reserved", "creative commons", "cc by", "cc0", "gpl", "proprietary", "spdx", "unencumbered"]

# Words of the notices that say nothing of licences by themselves.
COMMON = "example http https code everything here sa nc nd a all an and any are as at be by can copy file following for free from general has have hereby if in is it may more no not obtain of on one only or other permitted person project provided public see some source text that the their then these this to under use version was with without work you your mit der die das dem den des dieses steht unter sous la le les un une bajo el los las de del ce cet cette est et se este esta es ist dieser diese wird".split()


def _cut_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.+][^\W_]+)*", text.lower())


#: All words of notices and statements; those that a confirmed paragraph must have one of. (`mit` is a German word too; sa, nc and nd stand beside cc or a word of licensing.)
VOCABULARY = sorted({w for t in [*(n for ns in NOTICES.values() for n in ns), *(n for ns in NAMES.values() for n in ns), *(f.replace("{}", " ") for f in FORMS)] for w in _cut_words(t)})
KEYS = [w for w in VOCABULARY if w not in COMMON and w[0].isalpha()]
SAYING = sorted({w for f in FORMS for w in _cut_words(f.replace("{}", " "))} - set(COMMON))


#: Names that are no words of a language, by family, as their words; the others must be in capitals.
STRONG = {f: [" ".join(_cut_words(n)) for n in ns if any(c.isdigit() for c in n) or len(_cut_words(n)) > 2 or n in ("BSD", "GPLv2", "LGPL", "AGPL", "CC-BY")] for f, ns in NAMES.items()}
CAPITALS = {"MIT": "MIT", "ISC": "ISC"}


def _capitals(line: Column, name: str) -> Column:
    """The name in capitals, in a line that isn't all capitals."""
    return line.rlike(rf"(?U)\b{name}\b") & line.rlike(r"\p{Ll}")


def _has_key(text: Column) -> Column:
    """Has a word with the longest part of a key (a superset of those that have a key), or a name in capitals."""
    return _has_word(text) | reduce(lambda a, b: a | b, [text.contains(n) for n in CAPITALS.values()])


def _has_word(text: Column) -> Column:
    parts = sorted({max(re.split(r"[.+]", k), key=len) for k in KEYS})
    return F.arrays_overlap(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), F.array(*[F.lit(x) for x in parts]))


def _has_cue(low: Column) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(c) for c in CUES])


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:[.+][\p{L}\p{N}]+)*)"), F.lit(1))


def grams(w: Column) -> Column:
    """Distinct words, and pairs and triples of neighbours."""
    pairs = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit("$"))))
    triples = F.zip_with(pairs, F.slice(w, F.lit(3), F.greatest(F.size(w) - 2, F.lit(0))), lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit("$"))))
    return F.array_distinct(F.concat(w, pairs, triples))


def _pieces(notice: str) -> list[str]:
    w = notice.split()
    out = [notice]
    if len(w) > 12:
        out += [" ".join(w[i : i + 12]) for i in range(0, len(w) - 11, 6)]
    return out + [f"{notice} Thank you for reading", f"Note well: {notice}"]


def train(docs: DataFrame, background: int = 1500) -> tuple[DataFrame, list[str], list[float], float]:
    """(gram, weights array) of the grams with weight, families, intercepts, temperature.

    Bounds: the notices and statements above and the first paragraphs, where they have no licence cue, of at most background documents.
    """
    spark = docs.sparkSession
    known = [(p, f, n) for f, notices in NOTICES.items() for n in notices for p in _pieces(n)] + [(form.format(n), f, form) for f, names in NAMES.items() for n in names for form in FORMS] + [(m, UNKNOWN, m) for m in MENTIONS for _ in range(4)]
    other = bounded_sample(docs.where("text is not null").select("doc_id", F.substring_index("text", "\n", 1).alias("text")).where((F.length("text") > 0) & ~_has_cue(F.lower("text"))), F.struct("doc_id", "text"), background).select("text", F.lit(UNKNOWN).alias("family"), F.col("text").alias("source"))
    families = [*NOTICES, UNKNOWN]
    index = F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, float(i))])
    rows = spark.createDataFrame(known, "text string, family string, source string").union(other)
    rows = rows.select("family", index[F.col("family")].alias("label"), grams(words(F.col("text"))).alias("grams"), (F.pmod(F.xxhash64("source"), F.lit(HELD)) == 0).alias("held")).where(F.size("grams") > 0)
    weigh = F.when(F.col("family") == UNKNOWN, F.lit(1.0)).otherwise(F.lit(4.0))
    rows = cut(rows.withColumn("w", weigh).coalesce(1))

    def fitted(rows: DataFrame, steps: int) -> tuple:
        vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0, vocabSize=60_000).fit(rows.where(F.col("family") != UNKNOWN))
        return vocabulary, LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=2e-3, maxIter=steps, standardization=False, weightCol="w").fit(vocabulary.transform(rows))

    vocabulary, unseen = fitted(rows.where("not held"), 40)
    held = [(int(r["label"]), [float(x) for x in r["rawPrediction"]]) for r in unseen.transform(vocabulary.transform(rows.where("held"))).select("label", "rawPrediction").collect()]
    vocabulary, fit = fitted(rows, 60)
    weights, intercepts = fit.coefficientMatrix.toArray(), [float(x) for x in fit.interceptVector]
    table = [(g, [float(x) for x in weights[:, i]]) for i, g in enumerate(vocabulary.vocabulary) if weights[:, i].any()]

    def loss(t: float) -> float:
        total = 0.0
        for y, z in held:
            top = max(z)
            total += math.log(sum(math.exp((x - top) / t) for x in z)) - (z[y] - top) / t
        return total

    temperature = min([0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8], key=loss) if held else 1.0
    return spark.createDataFrame(table or [("", [0.0] * len(families))], "gram string, weights array<double>"), families, intercepts, temperature


def classify(paragraphs: DataFrame, model: tuple[DataFrame, list[str], list[float], float]) -> DataFrame:
    """paragraphs (lid, line; distinct) with family, probability, similarity, confirmed, alone (no other family's notice is as like)."""
    weights, families, intercepts, temperature = model
    rows = paragraphs.select("lid", "line", words(F.col("line")).alias("w"))
    scored = rows.select("lid", F.explode(grams(F.col("w"))).alias("gram")).join(F.broadcast(weights), "gram")  # at most the notices' grams
    sums = scored.groupBy("lid").agg(*[F.sum(F.col("weights")[i]).alias(f"z{i}") for i in range(len(families))])
    z = F.array(*[(F.coalesce(F.col(f"z{i}"), F.lit(0.0)) + intercepts[i]) / temperature for i in range(len(families))])
    out = rows.join(sums, "lid", "left").select("lid", "line", "w", z.alias("z")).withColumn("top", F.array_max("z"))
    best = F.get(F.array(*[F.lit(f) for f in families]), F.array_position("z", F.col("top")).cast("int") - 1)
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    out = out.select("lid", "line", "w", best.alias("family"), (1 / total).alias("probability"))
    notices = F.create_map(*[x for f, n in NOTICES.items() for x in (F.lit(f), F.array(*[words(F.lit(t)) for t in n]))])
    plain, own, family = F.array(*[F.lit(c) for c in COMMON]), F.array_distinct("w"), F.col("family")
    out = out.withColumn("own", own).withColumn("near", F.transform_values(notices, lambda f, n: F.transform(n, lambda t: F.struct(F.array_intersect("own", t).alias("shared"), F.size(F.array_distinct(t)).alias("size")))))
    part = lambda x: F.size(x["shared"]) / F.size("own")
    like = F.transform_values("near", lambda f, n: F.array_max(F.transform(n, lambda x: F.size(x["shared"]) / (F.size("own") + x["size"] - F.size(x["shared"])))))
    within = F.array_max(F.transform(F.col("near")[family], lambda x: F.size(x["shared"]) / x["size"]))
    most = F.transform_values("near", lambda f, n: F.array_max(F.transform(n, lambda x: F.when((F.size(x["shared"]) >= 3) & (F.size(F.array_except(x["shared"], plain)) >= 2), part(x)).otherwise(0.0))))
    first = lambda c: c[family] > F.array_max(F.map_values(F.map_filter(c, lambda f, x: f != family)))
    out = out.withColumns({"like": like, "within": within, "part": most})
    names = F.create_map(*[x for f in NOTICES for x in (F.lit(f), F.array(*[words(F.lit(n)) for n in NAMES.get(f, [])]).cast("array<array<string>>"))])
    named = F.transform_values(names, lambda f, n: F.coalesce(F.array_max(F.transform(F.filter(n, lambda t: F.size(F.array_except(t, "own")) == 0), lambda t: F.size(t))), F.lit(0)))
    letters = F.filter("own", lambda x: x.rlike(r"^\p{L}"))
    known = F.array(*[F.lit(x) for x in sorted({*COMMON, *SAYING, *(w for ns in NAMES.values() for n in ns for w in _cut_words(n))})])
    out = out.withColumns({"named": named, "said": F.size(F.array_intersect(letters, known)) / F.greatest(F.size(letters), F.lit(1))})
    says = (F.col("named")[family] > 0) & (F.col("named")[family] == F.array_max(F.map_values("named"))) & F.arrays_overlap("own", F.array(*[F.lit(x) for x in SAYING]))
    joined = F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" "))
    length = lambda n: F.when(joined.contains(f" {n} "), n.count(" ") + 1).otherwise(0)
    runs = {f: [length(n) for n in STRONG.get(f, [])] + ([F.when(_capitals(F.col("line"), CAPITALS[f]), 1).otherwise(0)] if f in CAPITALS else []) for f in NOTICES}
    out = out.withColumn("runs", F.create_map(*[x for f, found in runs.items() for x in (F.lit(f), F.array_max(F.array(*found)) if found else F.lit(0))]))
    under = F.arrays_overlap("own", F.array(*[F.lit(x) for x in sorted({*UNDER, *SAYING})])) | (F.size("w") <= 5)
    stated = (F.col("runs")[family] > 0) & (F.col("runs")[family] == F.array_max(F.map_values("runs"))) & under
    similarity = F.greatest(F.col("like")[family], F.col("within"), F.when(first(F.col("part")), F.col("part")[family]), F.when(says, F.col("said")), F.when(stated, F.lit(1.0)))
    key = F.arrays_overlap("own", F.array(*[F.lit(k) for k in KEYS])) | reduce(lambda a, b: a | b, [_capitals(F.col("line"), n) for n in CAPITALS.values()])
    sure = key & (family != UNKNOWN) & (F.col("probability") >= 0.5) & (F.col("similarity") >= 0.6)
    out = out.withColumn("similarity", F.coalesce(similarity, F.lit(0.0))).withColumns({"confirmed": F.coalesce(sure, F.lit(False)), "alone": F.coalesce(first(F.col("like")), F.lit(False))})
    return out.select("lid", "family", "probability", "similarity", "confirmed", "alone")


def line_id(line: Column) -> Column:
    """64 bits by which lines are told apart, so that joins and broadcasts carry no texts."""
    return F.xxhash64(line, F.length(line))


def wrapped(lines: DataFrame) -> DataFrame:
    """Runs of two or more neighbouring lines (doc_id, th, pos, lid, line) most of whose words are in one notice: doc_id, th, run (the pos of its lines), line (all of them)."""
    texts = [t for n in NOTICES.values() for t in n]
    own = F.array_distinct(words(F.col("line")))
    parts = F.array(*[words(F.lit(t)) for t in texts])
    near = F.filter(F.transform(parts, lambda t, i: F.when(F.size(F.array_intersect("own", t)) >= 0.6 * F.size("own"), i)), lambda i: i.isNotNull())
    by_line = cut(lines.groupBy("lid").agg(F.first("line").alias("line")).withColumn("own", own).select("lid", F.explode(near).alias("notice")))
    members = lines.join(small(by_line, by_line.count()), "lid")
    at = Window.partitionBy("doc_id", "th", "notice").orderBy("pos")
    members = members.withColumn("run", F.col("pos") - F.row_number().over(at))
    runs = members.groupBy("doc_id", "th", "notice", "run").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("all")).where(F.size("all") > 1)
    return runs.select("doc_id", "th", F.col("all.pos").alias("run"), F.array_join("all.line", " ").alias("line")).distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_paragraphs (with a licence cue or confirmed), licence, probability, similarity, confirmed, families.

    A paragraph is a line, or a run of wrapped lines that are confirmed together as one notice.

    licence is the family of the best paragraph: confirmed before unconfirmed, then by probability;
    `none` (0.0, 0.0, false) without such a paragraph, `unknown` if no paragraph's prediction is confirmed.
    families lists all confirmed ones. Null texts have no paragraphs.
    """
    keyed = docs.select("doc_id", text_hash().alias("th"), "text")
    full = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    lines = keyed.where(_has_key(F.col("text")) | _has_cue(F.lower("text"))).select("doc_id", "th", F.posexplode(full).alias("pos", "line"))
    own = F.array_distinct(words(F.col("line")))
    lines = lines.withColumns({"cue": _has_cue(F.lower("line")), "key": _has_key(F.col("line")), "own": own})
    told = F.size(F.array_intersect("own", F.array(*[F.lit(x) for x in VOCABULARY]))) >= 0.6 * F.size("own")  # no run without it
    lines = cut(lines.where(F.col("cue") | F.col("key") | told).drop("own").distinct().withColumn("lid", line_id(F.col("line"))))
    model = train(docs)
    runs = cut(wrapped(lines).where(_has_key(F.col("line"))).withColumn("lid", line_id(F.col("line"))))
    every = lines.where("cue or key").select("lid", "line").union(runs.select("lid", "line"))
    found = cut(classify(every.groupBy("lid").agg(F.first("line").alias("line")), model))
    look = small(found, found.count(), 500_000)
    joined_runs = cut(runs.join(look, "lid").where("confirmed and alone"))
    inside = joined_runs.select("doc_id", "th", F.explode("run").alias("pos")).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"i.{c}")) for c in ("doc_id", "th", "pos")])
    loose = lines.where("cue or key").alias("l").join(inside.alias("i"), same, "left_anti").select("doc_id", "th", "lid", "cue").distinct().join(look, "lid").where("cue or confirmed")
    columns = ["doc_id", "th", "lid", "family", "probability", "similarity", "confirmed"]
    joined = loose.select(columns).union(joined_runs.select(columns).distinct())
    rank = F.struct("confirmed", "probability", "similarity", F.when(F.col("confirmed"), F.col("family")).otherwise(UNKNOWN).alias("family"))
    per = joined.groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.max(rank).alias("best"), F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("all"))
    per = per.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), "n", "best", "all")
    return keyed.select("doc_id", "th").join(per, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")), "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("best.family", F.lit("none")).alias("licence"),
        F.coalesce("best.probability", F.lit(0.0)).alias("probability"),
        F.coalesce("best.similarity", F.lit(0.0)).alias("similarity"),
        F.coalesce("best.confirmed", F.lit(False)).alias("confirmed"),
        F.coalesce(F.array_join("all", ","), F.lit("")).alias("families"),
    )


def op9_licence_scan(docs: DataFrame) -> DataFrame:
    """scan(): one row for each row of documents.

    Null and empty texts have no paragraphs (`none`); very long texts are read whole, line by line;
    repeated rows and ids come out as often as they go in; paragraphs that tie go by probability,
    similarity, then family's name; columns besides doc_id and text are not read. An empty table gives
    an empty one.
    """
    return scan(docs)
