"""License notices in documents: MinHash bands find templates for text windows, shingles confirm them.

Templates of like length share windows: twice the next power of two of their words,
overlapping by half, so that a notice of a template's length lies whole in some window.
A window's set holds those of its shingles that some template of its class has, which
leaves the containment of any template as it is and raises every collision probability.
Bands are one row wide; their number is set per class from the least Jaccard similarity
that a contained template can have with a window's set, so that the chance to miss it is
below MISS. Containment is then counted on the shingles themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.llm.common import written_table

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
#: Templates are a closed list of short texts; their shingles become part of the plan.
MOST_SHINGLES = 20_000

# Notices as their licenses state them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software.",
    ),
    (
        "BSD-grant",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list"
        " of conditions and the following disclaimer.",
    ),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
    ),
)


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates), "license string, text string")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def _hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _shingle(hashes: Column, start: Column, size: int) -> Column:
    """Hash of ``size`` word hashes from place ``start`` (from 0) on."""
    return F.xxhash64(F.slice(hashes, start + 1, F.lit(size)))


def _starts(hashes: Column, size: int) -> Column:
    n = F.size(hashes)
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def _window_words(n: int) -> int:
    return 2 * 2 ** math.ceil(math.log2(max(n, 2)))


def _classes(templates: list) -> dict[tuple[int, int], dict]:
    """Per (window words, shingle words): the class's shingles and number of bands."""
    classes: dict[tuple[int, int], dict] = {}
    for t in templates:
        own = classes.setdefault((_window_words(t["n"]), t["k"]), {"shingles": set(), "least": math.inf})
        own["shingles"] |= set(t["shingles"])
        own["least"] = min(own["least"], len(set(t["shingles"])))
    for (window, k), own in classes.items():
        others = min(window - k + 1, len(own["shingles"]))
        shared = math.ceil(CONTAINMENT * own["least"])
        jaccard = shared / max(own["least"] + others - shared, own["least"])
        own["bands"] = 1 if jaccard >= 1 else math.ceil(math.log(MISS) / math.log(1 - jaccard))
    return classes


def _listed(shingles: list[int]) -> Callable[[Column], Column]:
    return lambda x: x["s"].isin(shingles)


def _placed(hashes: Column, k: int, words: list[int]) -> Column:
    """(p, s) of the shingles whose words all occur in templates."""

    def possible(i: Column) -> Column:
        out = F.lit(True)
        for j in range(k):
            out = out & F.get(hashes, i + j).isin(words)
        return out

    starts = F.filter(_starts(hashes, k), possible)
    return F.transform(starts, lambda i: F.struct(i.alias("p"), _shingle(hashes, i, k).alias("s")))


def _spots(window: int, k: int, bands: int) -> Callable[[Column], Column]:
    """The one or two windows that hold a whole shingle."""

    def spot(start: Column) -> Column:
        names = {"window": F.lit(window), "k": F.lit(k), "bands": F.lit(bands), "start": start}
        return F.struct(*[c.cast("int").alias(n) for n, c in names.items()])

    def spots(x: Column) -> Column:
        w = F.floor(x["p"] / (window // 2)) * (window // 2)
        both = F.array(spot(w - window // 2), spot(w))
        return F.filter(both, lambda s: (s["start"] >= 0) & (x["p"] + k <= s["start"] + window))

    return spots


def _within(k: int) -> Column:
    start, window = F.col("_w.start"), F.col("_w.window")
    return F.filter(F.col(f"_hits{k}"), lambda x: (x["p"] >= start) & (x["p"] + k <= start + window))


def license_matches(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """doc_id, license, containment, start_word and end_word (excluded) of each license in each document.

    Words are runs of ASCII letters and digits in lower case; shingles have five of them,
    or all words of a shorter template. A license is found if a window has 0.8 or more of
    its shingles; the best window counts, of equal ones the first, and its span runs from
    the first to the last of its shingles. Templates without words match nothing. Null
    and empty texts have no license. Rows with one id (null among them) count as one
    document and the same span is reported once. An empty table gives an empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    templates = template_table(spark) if templates is None else templates
    hashed = templates.select("license", _hashes(F.col("text")).alias("h")).withColumn("n", F.size("h")).filter("n > 0")
    known = [
        {"license": r["license"], "n": r["n"], "k": min(SHINGLE, r["n"]), "h": r["h"], "shingles": r["s"] if r["n"] >= SHINGLE else r["w"]}
        for r in hashed.withColumns({
            "s": F.transform(_starts(F.col("h"), SHINGLE), lambda i: _shingle(F.col("h"), i, SHINGLE)),
            "w": F.array(F.xxhash64("h")),
        }).collect()
    ]
    if sum(len(t["shingles"]) for t in known) > MOST_SHINGLES:
        raise ValueError(f"more than {MOST_SHINGLES} template shingles")
    classes = _classes(known)
    rows = docs.select("doc_id", _hashes(F.coalesce("text", F.lit(""))).alias("_h"))
    hits, windows = {}, []
    for k in sorted({k for _, k in classes}):
        words = sorted({h for t in known if t["k"] == k for h in t["h"]})
        shingles = sorted({s for t in known if t["k"] == k for s in t["shingles"]})

        hits[f"_hits{k}"] = F.filter(_placed(F.col("_h"), k, words), _listed(shingles))
    rows = rows.select("doc_id", *[c.alias(n) for n, c in hits.items()])
    for (window, k), own in classes.items():
        mine = F.filter(F.col(f"_hits{k}"), _listed(sorted(own["shingles"])))
        windows.append(F.array_distinct(F.flatten(F.transform(mine, _spots(window, k, own["bands"])))))
    # explode_outer: an inferred filter on the array would evaluate it a second time
    spread = rows.withColumn("_w", F.explode_outer(F.concat(*windows))).filter("_w is not null")
    inside = None
    for k in sorted({k for _, k in classes}):
        inside = inside.when(F.col("_w.k") == k, _within(k)) if inside is not None else F.when(F.col("_w.k") == k, _within(k))
    sets = spread.select("doc_id", "_w", inside.alias("_in"))
    # A window's set goes on only with the shingles of its own class.
    pruned = F.lit(None)
    for (window, k), own in classes.items():
        pick = F.filter("_in", _listed(sorted(own["shingles"])))
        pruned = F.when((F.col("_w.window") == window) & (F.col("_w.k") == k), pick).otherwise(pruned)
    sets = written_table(sets.select("doc_id", "_w", pruned.alias("_in")), "license_windows")

    def signature(values: Column, bands: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), bands), lambda r: F.array_min(F.transform(values, lambda s: F.xxhash64(s, r))))

    banded = sets.select("doc_id", "_w", "_in", F.posexplode(signature(F.col("_in.s"), F.col("_w.bands"))).alias("_band", "_value"))
    listed = spark.createDataFrame(
        [(t["license"], _window_words(t["n"]), t["k"], classes[_window_words(t["n"]), t["k"]]["bands"], sorted(set(t["shingles"]))) for t in known],
        "license string, t_window int, t_k int, t_bands int, shingles array<long>",
    )
    listed = listed.select("*", F.posexplode(signature(F.col("shingles"), F.col("t_bands"))).alias("t_band", "t_value"))
    same = (F.col("_value") == F.col("t_value")) & (F.col("_band") == F.col("t_band"))
    same = same & (F.col("_w.window") == F.col("t_window")) & (F.col("_w.k") == F.col("t_k"))
    # The templates are the bounded side; the bands of a small file of windows, as Spark sizes them, may not fit the driver.
    pairs = banded.join(F.broadcast(listed), same)
    shared = F.filter("_in", lambda x: F.array_contains("shingles", x["s"]))
    pairs = pairs.select("doc_id", "license", "_w", "shingles", shared.alias("_shared"))
    pairs = pairs.withColumn("containment", F.size(F.array_distinct("_shared.s")) / F.size("shingles"))
    span = F.struct(
        "containment", (-F.col("_w.start")).alias("order"), F.array_min("_shared.p").cast("long").alias("start_word"),
        (F.array_max("_shared.p") + F.col("_w.k")).cast("long").alias("end_word"),
    )
    best = pairs.filter(F.col("containment") >= CONTAINMENT).groupBy("doc_id", "license").agg(F.max(span).alias("best"))
    return best.select("doc_id", "license", "best.containment", "best.start_word", "best.end_word")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSE_SQL = f"""
with listed as (
  select license, regexp_extract_all(lower(text), '[a-z0-9]+') as words from (values
    {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}) as t(license, text)
), sized as (
  select *, least({SHINGLE}, len(words)) as k, 2 * pow(2, ceil(log2(greatest(len(words), 2))))::bigint as wide from listed
), shingles as (
  select distinct license, k, wide, array_to_string(words[i : i + k - 1], ' ') as shingle
  from sized, unnest(range(1, len(words) - k + 2)) as r(i)
), counted as (
  select *, count(*) over (partition by license) as n from shingles
), texts as (
  select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as words from documents
), placed as (
  select doc_id, k, i - 1 as p, array_to_string(words[i : i + k - 1], ' ') as shingle
  from texts, (select distinct k from sized) as ks, unnest(range(1, len(words) - k + 2)) as r(i)
), hits as (
  select doc_id, license, k, wide, n, p, shingle, unnest([p // (wide // 2) - 1, p // (wide // 2)]) * (wide // 2) as start
  from placed join counted using (k, shingle)
), windows as (
  select doc_id, license, start, count(distinct shingle) / any_value(n) as containment, min(p) as start_word, max(p) + any_value(k) as end_word
  from hits where start >= 0 and p + k <= start + wide group by doc_id, license, start
)
select doc_id, license, containment, start_word::bigint as start_word, end_word::bigint as end_word from (
  select *, row_number() over (partition by doc_id, license order by containment desc, start) as place from windows
  where containment >= {CONTAINMENT}
) where place = 1
"""
