"""Licence notices by Dice coefficient over word bigrams. DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which the licences are recognised, in the words their publishers recommend or that are common.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

# Fixed values too: passages of the publishers' notices and full texts. They are looked for in runs of words only.
PASSAGES: dict[str, tuple[str, ...]] = {
    "MIT": ("Licensed under the MIT License.",),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    **{
        f"CC-{k}-4.0": (
            f'By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons {v} 4.0 International Public License ("Public License").',
        )
        for k, v in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"))
    },
}

_OTHER = r"[^\p{L}\p{N}]+"


def _pairs(text: str) -> list[str]:
    w = re.sub(r"[^0-9a-z]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def bigrams(text: str) -> list[str]:
    """The different pairs of neighbouring words of ASCII text, on the driver."""
    return list(dict.fromkeys(_pairs(text)))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), _OTHER, " "), " "), lambda w: w != "")


def _runs(words: Column, known: list[tuple[str, list[str]]], percent: int) -> Column:
    """Runs of words that reach a template: ``dice, first, last, licence``, the last two places being those of words.

    A run has as many pairs as the template, and fewer only at the end of the text. It begins with a pair of the
    template, as a run that begins otherwise has no more of it. Of runs of a template that overlap by half, the best
    stays (ties: the first). What a template costs is bounded by its places times its length.
    """
    near = sorted({p for _, pairs in known for p in pairs})
    table = F.array(*[F.struct(F.lit(k).alias("licence"), F.lit(len(p)).alias("long"), F.lit(len(set(p))).alias("n"), F.array(*map(F.lit, dict.fromkeys(p))).alias("pairs")) for k, p in known])
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    places = F.filter(F.transform(pairs, lambda p, i: F.when(p.isin(near), F.struct(i.alias("at"), p.alias("pair")))), lambda x: x.isNotNull())

    def of(t: Column, found: Column) -> Column:
        own = F.filter(found, lambda x: F.array_contains(t["pairs"], x["pair"]))

        def run(x: Column, i: Column) -> Column:
            inside = F.filter(F.slice(own, i + 1, t["long"]), lambda y: y["at"] < x["at"] + t["long"])
            return F.struct((F.lit(2) * F.size(F.array_distinct(F.transform(inside, lambda y: y["pair"])))).alias("c"), (F.least(t["long"], n - x["at"]) + t["n"]).alias("of"), x["at"].alias("at"))

        def reached(runs: Column) -> Column:
            good = F.filter(runs, lambda r: 100 * r["c"] >= percent * r["of"])
            return F.transform(good, lambda r: F.struct((r["c"].cast("double") / r["of"]).alias("dice"), r["at"].alias("first"), F.least(r["at"] + t["long"], n).alias("last"), t["licence"].alias("licence")))

        def best(good: Column) -> Column:
            def beaten(r: Column, i: Column) -> Column:
                start = F.greatest(i + 1 - t["long"], F.lit(1))
                about = F.slice(good, start, 2 * t["long"])
                return F.exists(about, lambda o: (2 * F.abs(o["first"] - r["first"]) < t["long"]) & ((o["dice"] > r["dice"]) | ((o["dice"] == r["dice"]) & (o["first"] < r["first"]))))

            return F.filter(good, lambda r, i: ~beaten(r, i))

        # One-element arrays hold what is used several times, so that it is made once.
        return F.flatten(F.transform(F.array(reached(F.transform(own, run))), best))

    def all_of(found: Column) -> Column:
        have = F.transform(found, lambda x: x["pair"])
        # Fewer pairs in common than this reach no template, however short the run is.
        possible = F.filter(table, lambda t: (200 - percent) * F.size(F.array_intersect(t["pairs"], have)) >= percent * t["n"])
        return F.flatten(F.transform(possible, lambda t: of(t, found)))

    fewest = min(len(set(p)) for _, p in known) * percent / (200 - percent)
    return F.flatten(F.transform(F.filter(F.array(places), lambda x: F.size(x) >= fewest), all_of))


def scan(documents: DataFrame, percent: int = 80, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, passages: Mapping[str, tuple[str, ...]] = PASSAGES) -> DataFrame:
    """``doc_id, text`` to ``doc_id, licence, dice, line_no, n_notices``, a row for each row; other columns are ignored.

    Each line of a text, and the text as a whole, are compared with each template, as lower-cased words of letters and
    digits. With ``a`` and ``b`` pairs of neighbouring words, of which ``c`` different ones are common, Dice is
    ``2 * c / (a + b)``. A template is skipped if ``2 * min(a, b) / (a + b)`` is below ``percent`` / 100 already; texts and
    lines of which that is true for every template are skipped before their pairs are made. Then runs of words of each
    template's and each passage's length are compared, across lines and inside them, so that wrapped and embedded notices
    are found; a run inside a line that reaches the threshold, or in a text that does, is not one more notice.
    ``licence`` is that of the best template at or above the threshold (ties: lines before runs, the first line, the
    whole text counting as line 0, then the licence's name), ``line_no`` the line where it begins. ``n_notices`` counts
    the lines that reach it and the lines where other runs begin that touch none of these. Null and empty texts and texts
    without a notice have null, null, null and 0; rows that repeat give repeated rows. Nothing is shuffled, texts are
    read whole.
    """
    known = sorted({(k, *bigrams(t)) for k, texts in templates.items() for t in texts if bigrams(t)})
    sizes = [len(k) - 1 for k in known]
    shortest, longest = min(sizes) * percent / (200 - percent), max(sizes) * (200 - percent) / percent
    table = F.array(*[F.struct(F.lit(k[0]).alias("licence"), F.lit(len(k) - 1).alias("n"), F.array(*map(F.lit, k[1:])).alias("pairs")) for k in known])

    def hits(unit: Column) -> Column:
        near = F.filter(table, lambda t: 200 * F.least(unit["n"], t["n"]) >= percent * (unit["n"] + t["n"]))
        scored = F.transform(near, lambda t: F.struct(F.size(F.array_intersect(unit["pairs"], t["pairs"])).alias("c"), (unit["n"] + t["n"]).alias("of"), unit["line"].alias("line"), t["licence"].alias("licence")))
        reached = F.filter(scored, lambda s: 200 * s["c"] >= percent * s["of"])
        return F.transform(reached, lambda s: F.struct((F.lit(2.0) * s["c"] / s["of"]).alias("dice"), (-s["line"]).alias("line"), s["licence"].alias("licence")))

    def paired(unit: Column) -> Column:
        w = unit["words"]
        pairs = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.struct(unit["line"].alias("line"), (F.size(w) - 1).alias("n"), pairs.alias("pairs"))

    in_runs = sorted({(k, *_pairs(t)) for m in (templates, passages) for k, texts in m.items() for t in texts if bigrams(t)})
    lines = documents.select("doc_id", F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), _words).alias("lines"))
    total = F.aggregate("lines", F.lit(0), lambda n, x: n + F.size(x))
    whole = F.when(total - 1 <= longest, F.array(F.struct(F.lit(0).alias("line"), F.flatten("lines").alias("words")))).otherwise(F.array().cast("array<struct<line: int, words: array<string>>>"))
    units = F.concat(whole, F.transform("lines", lambda x, i: F.struct((i + 1).alias("line"), x.alias("words"))))
    runs = F.flatten(F.transform(F.array(F.flatten("lines")), lambda w: _runs(w, [(k, list(p)) for k, *p in in_runs], percent)))
    fitting = lines.select("doc_id", F.filter(units, lambda u: (F.size(u["words"]) - 1 >= shortest) & (F.size(u["words"]) - 1 <= longest)).alias("units"), runs.alias("runs"), F.transform("lines", lambda x: F.size(x)).alias("sizes"))
    found = fitting.select("doc_id", F.flatten(F.transform(F.transform("units", paired), hits)).alias("hits"), "runs", "sizes")
    # The line of each word, made only where a run was found.
    line_of = F.flatten(F.transform(F.when(F.size("runs") > 0, F.col("sizes")).otherwise(F.array().cast("array<int>")), lambda x, i: F.array_repeat(i + 1, x)))
    lined = found.withColumn("line_of", line_of).withColumn("noticed", F.array_distinct(F.transform("hits", lambda h: -h["line"])))
    put = F.transform("runs", lambda r: F.struct(r["dice"].alias("dice"), F.element_at("line_of", r["first"] + 1).alias("from"), F.element_at("line_of", r["last"] + 1).alias("to"), r["licence"].alias("licence")))
    inside = lambda r: F.array_contains("noticed", 0) | ((r["from"] == r["to"]) & F.array_contains("noticed", r["from"]))
    outside = lined.select("doc_id", "hits", "noticed", F.filter(put, lambda r: ~inside(r)).alias("runs"))
    by_line = F.transform("hits", lambda h: F.struct(h["dice"].alias("dice"), F.lit(1).alias("alone"), h["line"].alias("line"), h["licence"].alias("licence")))
    by_run = F.transform("runs", lambda r: F.struct(r["dice"].alias("dice"), F.lit(0).alias("alone"), (-r["from"]).alias("line"), r["licence"].alias("licence")))
    more = F.transform(F.filter("runs", lambda r: ~F.exists("noticed", lambda k: (k >= r["from"]) & (k <= r["to"]))), lambda r: r["from"])
    every = outside.select("doc_id", F.concat(by_line, by_run).alias("all"), F.array_union(F.array_remove("noticed", 0), more).alias("noticed"))
    top = every.withColumn("top", F.array_max(F.transform("all", lambda h: F.struct(h["dice"].alias("dice"), h["alone"].alias("alone"), h["line"].alias("line")))))
    tied = F.filter("all", lambda h: (h["dice"] == F.col("top.dice")) & (h["alone"] == F.col("top.alone")) & (h["line"] == F.col("top.line")))
    return top.select("doc_id", F.array_min(F.transform(tied, lambda h: h["licence"])).alias("licence"), F.col("top.dice").alias("dice"), (-F.col("top.line")).alias("line_no"), F.size("noticed").alias("n_notices"))
