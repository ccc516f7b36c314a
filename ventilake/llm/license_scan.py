"""Licence notices, by Dice coefficient over word bigrams with size bounds.

A document is compared as a whole, by paragraph (between blank lines), by line
and by sentence.  Each such unit is normalised (A-Z lower-cased, everything but
letters, digits and non-ASCII characters turned into single spaces) and reduced
to its set of word bigrams.  The Dice coefficient ``2 c / (a + b)`` of sets of
``a`` and ``b`` bigrams reaches ``t`` only if ``a`` lies between ``t b / (2 - t)``
and ``(2 - t) b / t``: units with fewer words or more distinct words than any
template allows are left before their bigrams are built, and a template is
compared only with units within its own bounds.  The bounds also say how many of
a template's bigrams a unit may lack, hence which few words a document must hold
one of to be looked at (``anchors``): nothing that could match is left out.  All of it runs on column
expressions within the row, without a shuffle.

Defined cases: null text counts as empty and has no notice; a unit of one word
has no bigrams and matches nothing; of equal coefficients the template whose
name sorts first is the best; repeated rows are reported one by one; a template
without bigrams matches nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import id_text

THRESHOLD = 0.8
#: licence names and the wording of their notices (fixed values)
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "BSD-2-Clause": "Released under the 2-Clause BSD License.",
    "BSD-3-Clause": "Released under the 3-Clause BSD License.",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: the standard notices in full, and the identifiers of SPDX
TEMPLATES |= {
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
}
_SPDX = (
    "AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 GPL-2.0-only"
    " GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense"
)
TEMPLATES |= {f"SPDX-{n}": f"SPDX-License-Identifier: {n}" for n in _SPDX.split()}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SENTENCE = "\x01"


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template, in order."""
    words = re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", text.translate(str.maketrans(_UPPER, _LOWER))).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams that a unit may have to reach the threshold with ``size`` of a template."""
    return math.ceil(threshold * size / (2 - threshold) - 1e-9), math.floor((2 - threshold) * size / threshold + 1e-9)


def anchors(own: list[str], threshold: float, uses: Counter | None = None) -> set[str]:
    """Words of which every unit that reaches the threshold with a template has at least one.

    Such a unit lacks at most so many of the template's bigrams; the longest
    words (of equally long ones those with the fewest ``uses``) that together
    touch one bigram more are taken."""
    lo, _ = bounds(len(own), threshold)
    lacking = len(own) - math.ceil(threshold * (lo + len(own)) / 2 - 1e-9)
    words, touched = set(), set()
    uses = uses or Counter()
    for word in sorted({w for b in own for w in b.split()}, key=lambda w: (-len(w), uses[w], w)):
        if len(touched) > lacking:
            break
        words.add(word)
        touched |= {b for b in own if word in b.split()}
    return words


def _units(text: Column) -> Column:
    """Words of the whole text, its paragraphs, lines and sentences: an array of arrays."""
    plain = F.regexp_replace(text, r"[.!?][ \t\r]+", _SENTENCE)
    plain = F.regexp_replace(plain, r"[^a-z0-9\x{80}-\x{10FFFF}\n\x01]+", " ")
    units = F.concat(
        F.array(F.translate(plain, "\n" + _SENTENCE, "  ")),
        F.transform(F.split(plain, r"\n ?\n"), lambda u: F.translate(u, "\n" + _SENTENCE, "  ")),
        F.transform(F.split(plain, "\n"), lambda u: F.translate(u, _SENTENCE, " ")),
        F.split(plain, "[\n\x01]"),
    )
    return F.transform(F.array_distinct(F.transform(units, lambda u: F.trim(u))), lambda u: F.split(u, " +"))


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id``, ``license`` (best, null if none), ``dice``, ``n_matches`` (units and
    templates that match) and ``licenses`` (names of all that match, sorted, comma-joined)."""
    known = {n: b for n, t in sorted((TEMPLATES if templates is None else templates).items()) if (b := bigrams(t))}
    rows = id_text(docs, id_col, text_col)
    kind = "array<struct<dice:double,name:string>>"
    if not known:
        rows = rows.select("doc_id", F.array().cast(kind).alias("matches"))
    else:
        limits = {n: bounds(len(b), threshold) for n, b in known.items()}
        least, most = min(lo for lo, _ in limits.values()), max(hi for _, hi in limits.values())
        any_of = F.array([F.lit(b) for b in dict.fromkeys(b for bs in known.values() for b in bs)])

        def sized(words: Column) -> Column:
            # a set of bigrams has at most words - 1 members and at least distinct words - 1
            return (F.size(words) > least) & (F.size(F.array_distinct(words)) - 1 <= most)

        def pairs(words: Column) -> Column:
            n = F.size(words) - 1
            return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))

        def compared(unit: Column) -> Column:
            tests = []
            for name, own in known.items():
                lo, hi = limits[name]
                common = F.size(F.array_intersect(unit, F.array([F.lit(b) for b in own])))
                dice = F.when(F.size(unit).between(lo, hi), 2.0 * common / (F.size(unit) + len(own)))
                tests.append(F.struct(dice.alias("dice"), F.lit(name).alias("name")))
            return F.filter(F.array(tests), lambda m: m["dice"] >= threshold)

        rows = rows.select("doc_id", F.translate("text", _UPPER + _SENTENCE, _LOWER).alias("text"))
        uses = Counter(w for b in known.values() for w in {w for x in b for w in x.split()})
        needed = sorted(set().union(*(anchors(b, threshold, uses) for b in known.values())))
        some = reduce(Column.__or__, [F.contains("text", F.lit(w)) for w in needed])
        rows = rows.select("doc_id", F.when(some, F.col("text")).otherwise("").alias("text"))
        rows = rows.select("doc_id", F.filter(_units(F.col("text")), sized).alias("units"))
        rows = rows.select("doc_id", F.transform("units", pairs).alias("units"))
        rows = rows.select("doc_id", F.filter("units", lambda u: F.arrays_overlap(u, any_of)).alias("units"))
        rows = rows.select("doc_id", F.flatten(F.transform("units", compared)).alias("matches"))
    best = F.element_at(F.array_sort("matches", lambda a, b: F.when(a["dice"] > b["dice"], -1).when(a["dice"] < b["dice"], 1).when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0)), 1)
    found = F.size("matches") > 0
    return rows.select(
        "doc_id",
        F.when(found, best["name"]).alias("license"),
        F.when(found, best["dice"]).alias("dice"),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"]))), ",").alias("licenses"),
    )


def oracle_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB SQL, over the table ``documents``."""
    values = ", ".join(
        "('{}', [{}], {}, {})".format(n, ", ".join(f"'{b}'" for b in bg), *bounds(len(bg), threshold))
        for n, t in sorted(templates.items())
        if (bg := bigrams(t))
    )
    return rf"""
WITH tpl(name, own, lo, hi) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(regexp_replace(
        translate(coalesce(text, ''), '{_UPPER}' || chr(1), '{_LOWER}'), '[.!?][ \t\r]+', chr(1), 'g'),
        '[^a-z0-9\x{{80}}-\x{{10FFFF}}\n\x01]+', ' ', 'g') AS p FROM documents),
u AS (
  SELECT rid, list_transform(list_distinct(list_transform(list_concat(
    [translate(p, chr(10) || chr(1), '  ')],
    list_transform(regexp_split_to_array(p, '\n ?\n'), lambda x: translate(x, chr(10) || chr(1), '  ')),
    list_transform(string_split(p, chr(10)), lambda x: translate(x, chr(1), ' ')),
    regexp_split_to_array(p, '[\n\x01]')), lambda x: trim(x, ' '))), lambda x: regexp_split_to_array(x, ' +')) AS units FROM d),
b AS (SELECT rid, k, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS g
      FROM (SELECT rid, unnest(units) AS w, generate_subscripts(units, 1) AS k FROM u) WHERE len(w) > 1),
m AS (SELECT rid, name, 2.0::DOUBLE * len(list_intersect(g, own)) / (len(g) + len(own)) AS dice
      FROM b JOIN tpl ON len(g) BETWEEN lo AND hi WHERE list_has_any(g, own)),
s AS (SELECT rid, count(*) AS n_matches, arg_min(name, (-dice, name)) AS license, max(dice) AS dice,
             string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM m WHERE dice >= {threshold} GROUP BY rid)
SELECT doc_id, license, dice, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN s USING (rid)
"""
