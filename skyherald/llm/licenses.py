"""Licence scans: Dice coefficient over word bigrams against templates, with size bounds.

A text's lines, its paragraphs of several lines, and runs of up to RUN neighbouring sentences of a paragraph (so that a
notice inside a longer line or wrapped in a comment is seen) are compared with each template as sets of word bigrams. Dice is
2 |A and B| / (|A| + |B|), so it can only reach `least` if the sizes a, b of the sets satisfy
b between a * least / (2 - least) and a * (2 - least) / least. Templates are therefore filed by every set size they can
match; a line looks up the few templates of its own size, and a line whose size no template admits is left at once. By the
same bound a match shares two thirds of a template's bigrams (at 0.8), so a text that holds none of a chosen third of them
(`required`) has no match and is not cut up at all. Of the templates one unit matches, those with the best value count.

Everything is an expression on the document's row: no join, no shuffle, no Python.

Defined results: a null or empty text has no licence; equal rows are scanned each; other columns are kept, a result
column replaces one of its name; templates of equal best value in a unit all count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, let, released

LEAST = 0.8
RUN = 4  # neighbouring sentences compared as one unit
# an end of a sentence; a version number ("2.0") has none inside
SENTENCE_END = r"""[.!?]+["')\]]*([ \t\n\r]|\z)"""
# fixed values: public licence notices as they are used in source files and texts
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)


def template_bigrams(text: str) -> list[str]:
    w = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def filed(templates: Sequence[tuple[str, str]], least: float) -> list[list[tuple[str, list[str]]]]:
    """For each set size the templates that can reach `least`; the list ends with the largest size."""
    sets = [(name, b) for name, text in templates if (b := template_bigrams(text))]
    top = max((math.floor(len(b) * (2 - least) / least + 1e-9) for _, b in sets), default=0)
    fits = lambda n, m: 2 * min(n, m) >= least * (n + m) - 1e-9
    return [[(name, b) for name, b in sets if n and fits(n, len(b))] for n in range(top + 1)]


def required(templates: Sequence[tuple[str, str]], least: float) -> list[str]:
    """Bigrams of which a text with a match holds at least one.

    A match of a template of b bigrams shares at least b * least / (2 - least) of them, so it cannot miss all of any set
    of one more than the rest; the longest bigrams, which are the rarest, make that set.
    """
    out = set()
    for _, text in templates:
        b = template_bigrams(text)
        shared = math.ceil(len(b) * least / (2 - least) - 1e-9)
        out.update(sorted(b, key=lambda x: (-len(x), x))[: len(b) - shared + 1])
    return sorted(out)


def _literal(files: list[list[tuple[str, list[str]]]]) -> Column:
    kind = "array<struct<name: string, bigrams: array<string>>>"
    one = lambda name, b: F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("bigrams"))
    return F.array(*[F.array(*[one(n, b) for n, b in file]).cast(kind) for file in files])


def _matches(unit: Column, files: Column, least: float) -> Column:
    """Templates with a Dice of `least` or more for one normalised line or paragraph: array<struct<name, dice>>."""
    none = F.array().cast("array<struct<name: string, dice: double>>")

    def compared(w: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))
        return let(F.array_distinct(pairs), scored)

    def scored(bigrams: Column) -> Column:
        def dice(t: Column) -> Column:
            both = F.size(F.array_intersect(bigrams, t.getField("bigrams")))
            value = 2.0 * both / (F.size(bigrams) + F.size(t.getField("bigrams")))
            return F.struct(t.getField("name").alias("name"), value.alias("dice"))

        candidates = F.coalesce(F.get(files, F.size(bigrams)), F.array().cast("array<struct<name: string, bigrams: array<string>>>"))
        best = lambda ms: F.greatest(F.array_max(F.transform(ms, lambda m: m.getField("dice"))), F.lit(float(least)))
        return let(F.transform(candidates, dice), lambda ms: let(best(ms), lambda top: F.filter(ms, lambda m: m.getField("dice") >= top)))

    # words can only repeat bigrams: more words than twice the largest set are still compared, fewer than two are not
    return let(F.split(F.btrim(unit), r"[ \n]+"), lambda w: F.when(F.size(w) < 2, none).otherwise(compared(w)))


def _units(t: Column, marked: Column) -> Column:
    """Lines, paragraphs of several lines, and runs of sentences (`marked` has a bar at the end of each) of a text."""

    def runs(paragraph: Column) -> Column:
        starts = lambda s: F.sequence(F.lit(1), F.size(s))
        from_start = lambda s, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(RUN), F.size(s) - i + 1)), lambda k: F.array_join(F.slice(s, i, k), " ")
        )
        return let(F.split(paragraph, r"\|"), lambda s: F.flatten(F.transform(starts(s), lambda i: from_start(s, i))))

    return F.concat(
        F.split(t, "\n"), F.filter(F.split(t, r"\n *\n"), lambda p: F.btrim(p).contains("\n")),
        F.flatten(F.transform(F.split(marked, r"\n *\n"), runs)),
    )


def license_scan(
    docs: DataFrame, text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with `licenses`: array<struct<name, dice>>, each name once with its best value, by name."""
    carry = list(docs.columns if carry is None else carry)
    files = _literal(filed(templates, least))
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    plain = F.lower(F.coalesce(F.col(f"in_{text}"), F.lit("")))
    marked = F.regexp_replace(F.regexp_replace(F.translate("plain", "|", " "), SENTENCE_END, "|$1"), r"[^a-z0-9\n|]+", " ")
    ask = r"\b(?:" + "|".join(b.replace(" ", r"[ \n]+") for b in required(templates, least)) + r")\b"
    shown = rows.select(held, plain.alias("plain")).select("row", "plain", F.regexp_replace("plain", r"[^a-z0-9\n]+", " ").alias("t"))
    units = F.when(F.col("t").rlike(ask), _units(F.col("t"), marked)).otherwise(F.array().cast("array<string>"))
    shown = shown.select("row", units.alias("units"))
    found = shown.select("row", F.flatten(F.transform("units", lambda u: _matches(u, files, least))).alias("found"))
    best = lambda name: F.array_max(F.transform(
        F.filter("found", lambda m: m.getField("name") == name), lambda m: m.getField("dice")
    ))
    names = F.sort_array(F.array_distinct(F.transform("found", lambda m: m.getField("name"))))
    listed = F.transform(names, lambda n: F.struct(n.alias("name"), best(n).alias("dice")))
    return released(found, carry, {"licenses": listed})
