"""License scans: windows of a text compared to licence templates by the Dice
coefficient over word bigrams.

Text and templates are normalised alike: lower case, runs of other characters
than letters and digits become one space, so that a notice is found inside a
line, over line ends or in a box of asterisks.  A template with ``t`` distinct bigrams is
compared to windows of ``t`` bigrams of the text that start at one of its own
bigrams (at the end of a text windows are shorter).

A window of at most ``t`` distinct bigrams reaches the coefficient ``c`` only with at
least ``c t / (2 - c)`` bigrams of the template.  This size bound prunes twice:

* templates: all but that many of a template's bigrams, and one more, are its
  probes; a text without a probe of it cannot hold it.  The probes of all
  templates are one table of bits by bigram hash and an index from bigram to
  templates, both literals, so a word costs the same for one template or a thousand;
* windows: as many bigrams of the template must lie within ``t`` places.

DataFrame and SQL functions only, no shuffle, no Python worker.  The list of templates is a
parameter on the driver and travels with the plan.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.llm.common import fresh

THRESHOLD = 0.8

# Licence notices, as (licence, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
     "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
     "the Software."),
    ("MIT", "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
     "to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the "
     "authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, "
     "tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the "
     "Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def normal_sql(text: str) -> str:
    """Words of a text: lower-cased runs of letters and digits."""
    return f"split(trim(regexp_replace(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+', ' ')), ' ')"


def bigrams_sql(words: str) -> str:
    """Hashes of the pairs of neighbouring words (none for fewer than two words)."""
    return f"transform(slice({words}, 2, greatest(size({words}) - 1, 0)), (b, i) -> xxhash64({words}[i], b))"


def _known(spark: SparkSession, templates) -> list[tuple[str, list[int], list[str]]]:
    """Name, distinct bigrams and their texts of each template with any."""
    if not templates:
        return []
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(templates)], "i int, name string, text string")
    rows = rows.selectExpr("i", "name", f"{normal_sql('text')} as w").selectExpr("i", "name", "w", f"{bigrams_sql('w')} as g")
    found = []
    for r in rows.orderBy("i").collect():  # the list of templates is a parameter
        pairs = dict(zip(r["g"], zip(r["w"], r["w"][1:])))
        if pairs:
            found.append((r["name"], list(pairs), ["".join(p) for p in pairs.values()]))
    return found


def least_common(n: int, threshold: float) -> int:
    """Bigrams of a template with ``n`` that a window must hold to reach the threshold."""
    return max(1, math.ceil(threshold * n / (2 - threshold) - 1e-9))


def _probes(known, threshold: float) -> dict[int, list[int]]:
    """Index from bigram to the templates it is a probe of.  Of each template the bigrams
    that the fewest templates hold, the longest first, are its probes."""
    held = Counter(g for _, grams, _ in known for g in grams)
    index = defaultdict(list)
    for i, (_, grams, texts) in enumerate(known):
        rare = sorted(zip(grams, texts), key=lambda x: (held[x[0]], -len(x[1]), x[0]))
        for g, _ in rare[: len(grams) - least_common(len(grams), threshold) + 1]:
            index[g].append(i)
    return index


def _longs(values) -> str:
    return f"array({', '.join(f'{v}L' if v > -(2**63) else 'bigint(-9223372036854775808)' for v in values)})" if values else "cast(array() as array<bigint>)"


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literals(known, threshold: float) -> tuple[str, int, str, int, str]:
    """SQL of the table of bits and its size, of the index and its size, of the templates."""
    index = _probes(known, threshold)
    places = 1 << max(6, (16 * len(index)).bit_length())
    words = [0] * (places // 64)
    for g in index:
        at = g % places
        words[at // 64] |= 1 << (at % 64)
    bits = _longs([w - (1 << 64) if w >= 1 << 63 else w for w in words])
    slots = 1 << max(4, len(index).bit_length())
    table = defaultdict(list)
    for g, owners in sorted(index.items()):
        table[g % slots].append(f"named_struct('g', {_longs([g])}[0], 't', array({', '.join(map(str, owners))}))")
    empty = "cast(array() as array<struct<g:bigint,t:array<int>>>)"
    slot = f"array({', '.join(f'array({", ".join(table[k])})' if table[k] else empty for k in range(slots))})"
    rows = [
        f"named_struct('name', {_quoted(name)}, 'g', {_longs(grams)}, 'n', {len(grams)}, 'least', {least_common(len(grams), threshold)})"
        for name, grams, _ in known
    ]
    return bits, places, slot, slots, f"array({', '.join(rows)})"


def scanned(
    docs: DataFrame, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, out: str = "licence"
) -> DataFrame:
    """``docs`` with a struct column ``out`` (with underscores in front where ``docs``
    has that name): ``license`` (the best template's, of equals the first by
    name; null if none reaches the threshold), ``dice`` (its coefficient or
    null), ``licenses`` (all that reach it, sorted, joined by commas; empty if
    none) and ``n_windows`` (windows that reach it, of all templates).

    ``templates`` is a sequence of (licence, text), of any length; one without two words
    matches nothing.  A null or empty text has no windows.  Every row stays,
    repeated ones too; an empty table gives no rows; other columns are carried along.
    """
    out = fresh(docs, out)
    known = _known(docs.sparkSession, templates)
    none = "named_struct('license', cast(null as string), 'dice', cast(null as double), 'licenses', '', 'n_windows', 0L)"
    if not known:
        return docs.withColumn(out, F.expr(none))
    bits, places, slot, slots, rows = _literals(known, threshold)
    # each step is bound by a one-element transform, so that no lambda computes an
    # outer array again for each of its elements
    likely = f"filter(g, h -> (shiftright({bits}[cast(pmod(h, {places}L) div 64 as int)], cast(pmod(h, 64L) as int)) & 1L) = 1L)"
    named = f"array_distinct(flatten(transform({likely}, h -> flatten(transform(filter({slot}[cast(pmod(h, {slots}L) as int)], e -> e.g = h), e -> e.t)))))"
    # places of the template's bigrams, and those at which a window has enough of them
    hits = "filter(sequence(0, size(g) - 1), i -> array_contains(t.g, g[i]))"
    starts = "filter(transform(p, (s, k) -> if(get(p, k + t.least - 1) < s + t.n, s, -1)), s -> s >= 0)"
    coefficient = "transform(array(array_distinct(slice(g, s + 1, t.n))), b -> 2.0D * size(array_intersect(b, t.g)) / (size(b) + t.n))[0]"
    windows = f"transform(flatten(transform(array({hits}), p -> {starts})), s -> named_struct('dice', {coefficient}, 'name', t.name))"
    scores = f"flatten(transform(transform({named}, i -> {rows}[i]), t -> {windows}))"
    top = "array_max(transform(h, x -> x.dice))"
    best = (
        "transform(array(named_struct('h', h, 'top', " + top + ")), b -> named_struct("
        "'license', array_min(transform(filter(b.h, x -> x.dice = b.top), x -> x.name)), 'dice', b.top, "
        "'licenses', array_join(sort_array(array_distinct(transform(b.h, x -> x.name))), ','), 'n_windows', cast(size(b.h) as bigint)))[0]"
    )
    reached = f"filter({scores}, x -> x.dice >= {threshold!r}D)"
    column = f"`{text}`"
    judge = (
        f"transform(transform(array({normal_sql(column)}), w -> {bigrams_sql('w')}), g -> "
        f"transform(array({reached}), h -> if(size(h) = 0, {none}, {best}))[0])[0]"
    )
    return docs.withColumn(out, F.expr(judge))
