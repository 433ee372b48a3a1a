"""License scan (native): Dice coefficient over word bigrams against license templates.

Units are the sentences and lines of a text.  A unit is compared with the templates
whose size lets the coefficient reach the threshold: with A and B distinct bigrams,
``t/(2-t) * B <= A <= (2-t)/t * B``.  Before texts are cut into units, those that hold
none of a template's telling bigrams are passed by: a unit that reaches the threshold
misses at most ``B - ceil(t/(2-t) * B)`` bigrams of its template, so of one more than
that many bigrams it holds one.  Both bounds lose nothing.

What no unit reaches is looked for in windows of words, which run across the ends of lines and
sentences: wrapped and embedded notices, and the texts and headers in NOTICES.  A window starts
and ends with a bigram of its template (trimming others only raises the coefficient) and has at
most ``(2-t)/t`` times its words; of windows that overlap, the one of the highest coefficient counts.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talus.llm.common import text_of

THRESHOLD = 0.8
#: Ends of a unit: white space after a sentence mark, or line ends.
CUT = r"(?<=[.!?;])[ \t]+|[\r\n]+"

#: Templates: short notices by license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Licence texts and standard headers, looked for in windows only.
NOTICES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD-3-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def telling(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """For each template as many bigrams, rarest among the templates first, as leave no unit out."""
    sets = [bigrams_of(t) for _, t in templates]
    seen = {b: sum(b in s for s in sets) for s in sets for b in s}
    out = set()
    for s in sets:
        least = math.ceil(threshold / (2 - threshold) * len(s) - 1e-9)
        out |= set(sorted(s, key=lambda b: (seen[b], -len(b), b))[: len(s) - least + 1])
    return sorted(out)


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _bigrams(unit: Column) -> Column:
    # the words are bound once: named inside the inner function, they would be split anew for each word
    first = lambda w: F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
    pairs = lambda w: F.zip_with(first(w), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.transform(F.array(F.split(unit, " ")), pairs)[0])


def _any(words: list[str]) -> str:
    """An expression for any of ``words``, by their first characters, so that a place is left early."""
    tails: dict[str, list[str]] = {}
    for w in words:
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    out = "|".join(("[^a-z0-9]+" if c == " " else c) + _any(t) for c, t in sorted(tails.items()))
    return f"(?:{out})" + ("?" if "" in words else "") if out else ""


def _gate(templates, threshold: float) -> Column:
    return F.rlike(F.lower("text"), F.lit(f"(?<![a-z0-9]){_any(telling(templates, threshold))}(?![a-z0-9])"))


def _best(grams: Column, templates, threshold: float) -> Column:
    lo, hi = threshold / (2 - threshold), (2 - threshold) / threshold
    reached = []
    for name, t in templates:
        of = bigrams_of(t)
        dice = 2 * F.size(F.array_intersect(grams, F.array(*map(F.lit, of)))) / (F.size(grams) + len(of))
        fits = F.size(grams).between(math.ceil(lo * len(of) - 1e-9), math.floor(hi * len(of) + 1e-9))
        reached.append(F.when(fits, F.when(dice >= threshold, F.struct((-dice).alias("rank"), F.lit(name).alias("license")))))
    return F.array_min(F.array_compact(F.array(*reached)))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _windows(text: Column, templates, notices, threshold: float) -> Column:
    """Windows (rank, license, a, b: first and last bigram) outside of the units that reach a template."""
    lo, hi = threshold / (2 - threshold), (2 - threshold) / threshold
    unit = lambda u: F.when(_best(_bigrams(u), templates, threshold).isNull(), F.split(u, " ")).otherwise(F.array(F.lit("|")))
    words = F.filter(F.flatten(F.transform(F.split(text, CUT), lambda u: _bound(_plain(u), unit))), lambda w: w != "")
    first = lambda w: F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
    grams = _bound(words, lambda w: F.zip_with(first(w), F.slice(w, 2, F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b)))

    def of(g: Column, name: str, template: str) -> Column:
        have = bigrams_of(template)
        least, most = math.ceil(lo * len(have) - 1e-9), math.floor(hi * len(words_of(template)))
        own = F.array(*map(F.lit, have))

        def window(a: Column, b: Column) -> Column:
            dice = lambda x, both: F.struct((-2 * both / (F.size(F.array_distinct(x)) + len(have))).alias("rank"), F.lit(name).alias("license"), a.alias("a"), b.alias("b"), (-both).alias("both"))
            return _bound(F.slice(g, a + 1, b - a + 1), lambda x: _bound(F.size(F.array_intersect(x, own)), lambda both: dice(x, both)))

        def at(hits: Column) -> Column:
            ends = lambda a: F.filter(hits, lambda b: (b - a + 1 >= least) & (b - a < most))
            return F.flatten(F.transform(hits, lambda a: F.filter(F.transform(ends(a), lambda b: window(a, b)), lambda x: x["rank"] <= -threshold)))

        spots = F.filter(F.transform(g, lambda x, i: F.when(F.array_contains(own, x), i)), lambda i: i.isNotNull())
        return F.when(F.size(F.array_intersect(g, own)) >= least, _bound(_bound(spots, at), apart))

    def apart(found: Column) -> Column:
        meets = lambda kept, x: F.exists(kept, lambda k: (k["a"] <= x["b"] + 1) & (x["a"] <= k["b"] + 1))
        return F.aggregate(F.array_sort(found), F.slice(found, 1, 0), lambda kept, x: F.when(meets(kept, x), kept).otherwise(F.concat(kept, F.array(x))))

    every = lambda g: F.transform(F.flatten(F.array_compact(F.array(*[of(g, n, t) for n, t in (*templates, *notices)]))), lambda x: F.struct(*[x[c].alias(c) for c in ("both", "rank", "license", "a", "b")]))
    return _bound(_bound(grams, every), apart)


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, notices=NOTICES) -> DataFrame:
    """Each unit, and each window outside of them, that reaches the threshold: row columns of
    ``docs``, license and dice.

    A unit that several templates reach counts for the highest coefficient, then the license
    first in order of name.
    """
    # one expression inside the generator: as columns of their own, bigrams and coefficients would
    # be copied into each of the filters and projections that name them
    units = F.transform(F.split("text", CUT), lambda unit: _bigrams(_plain(unit)))
    reached = F.array_compact(F.transform(units, lambda grams: _best(grams, templates, threshold)))
    wide = F.transform(_windows(F.col("text"), templates, notices, threshold), lambda x: F.struct(x["rank"].alias("rank"), x["license"].alias("license")))
    return docs.where(_gate((*templates, *notices), threshold)).withColumn("__best", F.explode(F.concat(reached, wide))).drop("text").withColumns(
        {"license": F.col("__best.license"), "dice": -F.col("__best.rank")}
    ).drop("__best")


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that hold a license notice: doc_id, licenses (names by order, comma-joined),
    n_notices, best_dice.

    Rows of one id (null ids too) count together; null and empty texts and those without a notice have
    no row, and an empty table gives none.  A text is read once, whole, however long: only bigrams of
    templates start a window, so that the work beyond reading is in proportion to notices and not to the text.
    """
    found = matches(docs.select("doc_id", text_of().alias("text")), templates, threshold)
    return found.groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.count("*").alias("n_notices"),
        F.round(F.max("dice"), 4).alias("best_dice"),
    )
