"""Licence scans: a trained paragraph classifier in DataFrame functions.

Every paragraph (line) of a text that holds an anchor, an n-gram whose weight
speaks for some licence against "no licence" (without one no paragraph can
become a finding), is cut into word 1-, 2- and 3-grams and
scored by sparse multinomial logistic regression over licence families, with a
class for "no licence". Probabilities are calibrated by a temperature fitted on
cross-validated scores; below ``MIN_PROBABILITY`` a paragraph is ``unknown``.
Predictions are confirmed by comparing the paragraph's word pairs with the
family's templates.

The weights are fitted on the labelled paragraphs below (a few dozen, L1 by
proximal gradient) when the plan is made; they become literals of the plan, so
the scan is one projection without a shuffle, a join or Python.

Defined results: null and empty texts, and texts without an anchor, have no
findings; words are compared in lower case (A-Z), numbers are ignored;
paragraphs are numbered from 0 by line; equal paragraphs are found each time;
of equally likely families the first by name stands; empty tables give empty
results.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = "none"
GRAMS = 3
L1 = 0.002
ROUNDS = 1500
MIN_PROBABILITY = 0.5
MIN_SIMILARITY = 0.5     # share of a template's word pairs that confirms

WORD = r"[^\x00-\x60\x7B-\x7F]+"      # letters a-z and anything beyond ASCII, after lower-casing

# The labelled table: (family, paragraph).
LABELLED = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "This project is released under the Apache 2.0 license."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, without warranties or conditions of any kind."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Distributed under the BSD 3-Clause License."),
    ("bsd", "Licensed under the BSD license."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("creative-commons", "Licensed under CC BY-NC 4.0."),
    ("creative-commons", "Licensed under CC BY 4.0."),
    ("creative-commons", "Licensed under CC BY-SA 3.0."),
    ("creative-commons", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("creative-commons", "This text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."),
    ("creative-commons", "SPDX-License-Identifier: CC-BY-4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("gpl", "Licensed under the GPL, version 2 or later."),
    ("gpl", "Released under the GNU Lesser General Public License."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("gpl", "GNU GPL v3"),
    ("gpl", "Distributed under GPLv2 or later."),
    ("gpl", "GPLv3"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "This project is MIT licensed, see the LICENSE file."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mozilla", "Licensed under the Mozilla Public License 2.0."),
    ("mozilla", "SPDX-License-Identifier: MPL-2.0"),
    ("mozilla", "MPL 2.0"),
    ("public-domain", "CC0 1.0 Universal"),
    ("public-domain", "Dedicated under CC0 1.0"),
    ("public-domain", "This work has been dedicated to the public domain."),
    ("public-domain", "To the extent possible under law, the author has waived all copyright and related rights to this work, which is in the public domain."),
    ("public-domain", "Released into the public domain under CC0."),
    ("reserved", "All rights reserved."),
    ("reserved", "Copyright 2020 The Publisher. All rights reserved."),
    ("reserved", "No part of this publication may be reproduced without the prior written permission of the publisher, all rights reserved."),
    ("reserved", "(c) 2019 Company. All rights reserved worldwide."),
    (NONE, "She asked for permission to leave the room and went home early."),
    (NONE, "The driver lost his license after the accident in the city."),
    (NONE, "A fishing licence costs ten crowns a year and is sold at the town hall."),
    (NONE, "The car comes with a warranty of two years on all parts."),
    (NONE, "Copyright law in Europe was changed by a directive in that year."),
    (NONE, "The court ruled that copyright does not protect ideas."),
    (NONE, "The police had a warrant to search the house for the missing version of the letter."),
    (NONE, "All rights of way across the fields stay open to the public."),
    (NONE, "He had licensed the patent to a firm in Boston, which made the engine."),
    (NONE, "Wealth was redistributed by the new tax, said the general in his work."),
    (NONE, "The software is sold with a license for one year and may be used on one computer."),
    (NONE, "Taxi licences are released by the city under a new law each spring."),
    (NONE, "They fought for equal rights, and all rights were theirs in the end."),
    (NONE, "The public domain name was registered by an unknown company."),
    (NONE, "You may not leave without permission, this rule is subject to terms."),
    (NONE, "The following day she went under this bridge and came back later."),
    (NONE, "Sooner or later this has to end, or so they said in the following week."),
    (NONE, "He took a copy of the letter free of charge to any person under the age of ten."),
    (NONE, "This table was reserved for the following guests."),
    (NONE, "Under the general public order of that year this was the law."),
    (NONE, "Er fuhr mit dem Zug in die Stadt und kam mit den Kindern zurück."),
    (NONE, "Sie sprach mit der Frau, die in dem Haus am Ende der Straße wohnte."),
    (NONE, "Das Kind spielt mit einem Ball, und die Katze ist mit im Garten."),
    (NONE, "Auf der Reise mit seinem Vater sah er die Berge."),
    (NONE, "Geht er mit, so geht sie auch mit."),
    (NONE, "Mit der Zeit wird es besser, mit ihm nicht."),
    (NONE, "The licence fee of the broadcaster was raised in January."),
)
FAMILIES = sorted({f for f, _ in LABELLED if f != NONE}) + [NONE]


def words_of(paragraph: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in paragraph)
    return re.findall(WORD, low)


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)}


def pairs_of(words: list[str]) -> list[str]:
    return sorted({" ".join(words[i:i + 2]) for i in range(len(words) - 1)})


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """Multinomial logistic regression; the last row of x is the intercept,
    all other weights carry an L1 penalty (accelerated proximal gradient)."""
    w = v = np.zeros((x.shape[1], classes))
    target = np.eye(classes)[y]
    step = 1 / (0.5 * np.linalg.norm(x, 2) ** 2 / len(x))
    t = 1.0
    for _ in range(ROUNDS):
        new = v - step * (x.T @ (_softmax(x @ v) - target)) / len(x)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * L1, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


@lru_cache(1)
def trained() -> tuple[dict[str, list[float]], list[float]]:
    """Weights of the n-grams that have any, and the intercepts, both already
    divided by the calibration's temperature; in the order of FAMILIES."""
    bags = [grams_of(words_of(t)) for _, t in LABELLED]
    y = np.array([FAMILIES.index(f) for f, _ in LABELLED])
    vocabulary = sorted(set().union(*bags))
    x = np.array([[float(g in b) for g in vocabulary] + [1.0] for b in bags])
    held = np.arange(len(y)) % 5
    z = np.vstack([np.hstack([x[held == k] @ fit(x[held != k], y[held != k], len(FAMILIES)), y[held == k][:, None]]) for k in range(5)])
    heat = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0),
               key=lambda h: -np.log(_softmax(z[:, :-1] / h)[np.arange(len(z)), z[:, -1].astype(int)] + 1e-12).sum())
    w = fit(x, y, len(FAMILIES)) / heat
    return {g: w[i].tolist() for i, g in enumerate(vocabulary) if w[i].any()}, w[-1].tolist()


@lru_cache(1)
def anchors() -> str:
    """An expression (Java and Python) for the paragraphs, in lower case, that
    the classifier can take for a licence. The intercepts favour "no licence",
    so a paragraph needs an n-gram that raises some family against it."""
    weights, bias = trained()
    none = FAMILIES.index(NONE)
    if max(bias) > bias[none]:
        return ""
    raising = {g for g, w in weights.items() if max(w) > w[none]}
    # an n-gram is there only if its parts are; the shortest are enough
    least = [g for g in sorted(raising) if not any(h != g and f" {h} " in f" {g} " for h in raising)]
    other = r"[\x00-\x60\x7B-\x7F]"
    return f"(?:^|{other})(?:" + "|".join(re.escape(g).replace(r"\ ", other + "+") for g in least) + f")(?:{other}|$)"


def __getattr__(name: str) -> str:
    if name == "ANCHORS":
        return anchors()
    raise AttributeError(name)


def templates() -> dict[str, list[list[str]]]:
    return {f: [p for g, t in LABELLED if g == f and (p := pairs_of(words_of(t)))] for f in FAMILIES if f != NONE}


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _findings(paragraph: Column, number: Column) -> Column:
    """One candidate paragraph (in lower case) as a finding."""
    weights, bias = trained()
    known = _strings(sorted(weights))
    table = F.map_from_arrays(known, F.array(*[F.array(*map(F.lit, weights[g])) for g in sorted(weights)]))

    def of_words(words: Column) -> Column:
        n = F.size(words)

        def joined(k: int) -> Column:
            return F.when(n >= k, F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, k), " "))
                          ).otherwise(F.array().cast("array<string>"))

        hits = F.array_intersect(F.concat(*[joined(k) for k in range(1, GRAMS + 1)]), known)
        scores = F.aggregate(hits, F.array(*map(F.lit, bias)), lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b))
        pairs = F.array_distinct(joined(2))
        return F.transform(F.array(F.struct(scores.alias("z"), pairs.alias("p"))), of_scores)[0]

    def of_scores(s: Column) -> Column:
        top = F.array_max(s["z"])
        total = F.aggregate(s["z"], F.lit(0.0), lambda acc, z: acc + F.exp(z - top))
        best = F.element_at(_strings(FAMILIES), F.array_position(s["z"], top).cast("int"))
        probability = 1 / total
        sure = (best != NONE) & (probability >= MIN_PROBABILITY)

        def alike(family: str, pairs: list[list[str]]) -> Column:
            return F.greatest(*[F.size(F.array_intersect(s["p"], _strings(t))) / F.lit(float(len(t))) for t in pairs], F.lit(0.0))

        similarity = F.lit(0.0)
        for family, pairs in templates().items():
            similarity = F.when(best == family, alike(family, pairs)).otherwise(similarity)
        return F.struct(number.cast("int").alias("paragraph"),
                        F.when(best == NONE, F.lit(NONE)).when(sure, best).otherwise(F.lit("unknown")).alias("family"),
                        F.round(probability, 9).alias("probability"), F.round(similarity, 9).alias("similarity"),
                        (sure & (similarity >= MIN_SIMILARITY)).alias("confirmed"))

    return F.transform(F.array(F.regexp_extract_all(paragraph, F.lit(f"({WORD})"), F.lit(1))), of_words)[0]


def scan(docs: DataFrame, text: str = "text", out: str = "licences") -> DataFrame:
    """``docs`` with the array column ``out``: a struct ``paragraph, family,
    probability, similarity, confirmed`` for each paragraph with an anchor that
    is not plainly without a licence."""
    low = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kind = "array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>"
    lines = F.transform(F.split(low, "\n"), lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    anchored = F.filter(lines, lambda x: x["p"].rlike(anchors()))
    found = F.filter(F.transform(anchored, lambda x: _findings(x["p"], x["i"])), lambda f: f["family"] != NONE)
    return docs.withColumn(out, F.when(low.rlike(anchors()), found).otherwise(F.array().cast(kind)))
