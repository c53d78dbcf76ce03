"""License scans in DataFrame functions only.

A text is words (letters and digits, lower case), and five words in a row are a shingle. Windows
of half more words than a template, at steps of an eighth, get MinHash signatures, so a notice
that foreign words have stretched by up to three eighths lies in one of them whole, wherever it
stands; each of ``BANDS`` bands is one coordinate. A window
that holds a template to 0.8 is at least 0.45 similar to it, so all bands miss it with a
probability below 0.55 ** 24, one in a million. Windows that share a band with a template are
verified: the share of the template's distinct shingles that the window has.

Two conditions that every match meets keep windows few. A text must contain one of the words that
lie in so many of a template's shingles that 0.8 of them cannot do without; and windows are only
looked at where they hold some template shingle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import filled, register, table

WIDTH = 5
LEAST = 0.8
BANDS = 24
_BETWEEN = r"[^\p{L}\p{N}]+"

# fixed values: wordings of public licenses and their usual notices
TEMPLATES = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
        express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met""",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
        the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
        this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _BETWEEN), "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of WIDTH words in order; fewer words make one, none make none."""
    n = F.size(words)
    return (
        F.when(n >= WIDTH, F.transform(F.sequence(F.lit(1), n - (WIDTH - 1)), lambda i: F.xxhash64(F.slice(words, i, WIDTH))))
        .when(n > 0, F.array(F.xxhash64(words)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def signature(shingles: Column) -> Column:
    def lowest(k: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(k))))

    return F.array(*[lowest(k) for k in range(BANDS)])


def window_of(words: int) -> tuple[int, int]:
    """Window length in words and step for a template of so many words."""
    return words + max(1, words // 2), words // 8 + 1


def _plain_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def needed_words(text: str) -> set[str]:
    """Words of a template of which any window that holds it to LEAST has at least one; long words first."""
    w = _plain_words(text)
    grams = {tuple(w[k : k + WIDTH]) for k in range(max(1, len(w) - WIDTH + 1))}
    may_lack = len(grams) - -int(-len(grams) * LEAST // 1)
    chosen: set[str] = set()
    for word in sorted(set(w), key=lambda x: (-len(x), x)):
        if sum(bool(chosen.intersection(g)) for g in grams) > may_lack:
            break
        chosen.add(word)
    return chosen


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and license found: id_col, license, shared, shingles, windows, first_word.

    shared: most distinct shingles of the template in one window, of ``shingles`` that it has;
    windows: how many windows hold at least LEAST of it; first_word: where the first of them
    begins. Templates (a small dictionary, a few thousand words in all) without words are left out.
    Null, empty and wordless texts and empty tables give no rows; a null id is reported as null;
    rows with the same id and text count once. Other columns are not read.
    """
    templates = {k: t for k, t in (TEMPLATES if templates is None else templates).items() if _plain_words(t)}
    spark = docs.sparkSession
    if not templates:
        return docs.select(F.col(id_col), *[F.lit(None).cast(t).alias(c) for c, t in _FOUND.items()]).filter(F.lit(False))
    known = _known(spark, templates)
    rows = known.collect()  # as many as there are templates
    needed = sorted(set().union(*(needed_words(t) for t in templates.values())))
    every = F.array(*[F.lit(g) for g in sorted({g for r in rows for g in r["grams"]})]).cast("array<bigint>")
    kinds = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(window_of(m)[0] - WIDTH + 1).alias("grams"), F.lit(window_of(m)[1]).alias("step")) for m in sorted({r["m"] for r in rows})])

    low = F.lower(filled(text_col))
    holds = F.lit(False)
    for w in needed:
        holds = holds | F.contains(low, F.lit(w))
    words = _once(docs.filter(holds).select(F.col(id_col).alias("id"), F.xxhash64(filled(text_col)).alias("text_key"), words_of(filled(text_col)).alias("words")))
    grams = _once(words.select("id", "text_key", shingles_of(F.col("words")).alias("grams")))
    found = _once(grams.select("id", "text_key", "grams", F.array_intersect("grams", every).alias("common"))).filter(F.size("common") > 0)
    at = F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda i: F.array_contains(F.col("common"), F.get(F.col("grams"), i)))
    found = _once(found.select("id", "text_key", "grams", at.alias("hits"))).select("id", "text_key", "grams", "hits", F.explode(kinds).alias("kind"))
    span = F.greatest(F.col("kind.grams"), F.lit(1))
    at_hit = F.array_distinct(
        F.flatten(
            F.transform(
                "hits",
                lambda p: F.filter(
                    F.sequence(F.greatest(F.ceil((p - span + 1) / F.col("kind.step")).cast("int"), F.lit(0)), F.floor(p / F.col("kind.step")).cast("int")),
                    lambda w: (w * F.col("kind.step") <= p) & (w * F.col("kind.step") + span > p),
                ),
            )
        )
    )
    windows = (
        found.select("id", "text_key", "grams", "kind", span.alias("span"), F.explode(at_hit).alias("window"))
        .withColumn("first_word", F.col("window") * F.col("kind.step"))
        .select("id", "text_key", F.col("kind.m").alias("m"), "first_word", F.expr("slice(grams, first_word + 1, span)").alias("grams"))
    )
    banded = _once(windows).select("id", "text_key", "m", "first_word", "grams", F.posexplode(signature(F.col("grams"))).alias("band", "value"))
    bands = known.select("license", "m", F.col("grams").alias("template"), F.posexplode(signature(F.col("grams"))).alias("band", "value"))
    shared = F.size(F.array_intersect("grams", "template"))
    return (
        banded.join(F.broadcast(bands), ["m", "band", "value"])  # templates times BANDS rows
        .select("id", "text_key", "license", "first_word", shared.alias("shared"), F.size("template").alias("shingles"))
        .filter(F.col("shared") >= F.col("shingles") * LEAST)
        .groupBy("id", "text_key", "license", "shingles")
        .agg(F.max("shared").alias("shared"), F.countDistinct("first_word").alias("windows"), F.min("first_word").alias("first_word"))
        .select(
            F.col("id").alias(id_col), "license", F.col("shared").cast("long").alias("shared"), F.col("shingles").cast("long").alias("shingles"),
            "windows", F.col("first_word").cast("long").alias("first_word"),
        )
    )


def _once(df: DataFrame) -> DataFrame:
    """The same rows; columns that later expressions use many times are computed once per row."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


_FOUND = {"license": "string", "shared": "bigint", "shingles": "bigint", "windows": "bigint", "first_word": "bigint"}


def _known(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, m words, distinct grams) of each template."""
    pairs = [F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, t in templates.items()]
    listed = spark.range(1).select(F.explode(F.array(*pairs)).alias("t"))
    words = _once(listed.select("t.license", words_of(F.col("t.text")).alias("words")))
    return _once(words.select("license", F.size("words").alias("m"), F.array_distinct(shingles_of(F.col("words"))).alias("grams")))


def check_sql(templates: dict[str, str] | None = None) -> str:
    """The same by brute force: shingles as strings, all windows that hold a template shingle, no signatures."""
    templates = TEMPLATES if templates is None else templates
    values = ", ".join("('{}', '{}')".format(k, " ".join(_plain_words(t))) for k, t in templates.items())
    return rf"""
    with t as (select license, string_split(w, ' ') w from (values {values}) v(license, w)),
    tm as (select license, w, len(w) m, greatest(1, len(w) // 2) extra from t),
    tg as (
      select distinct license, m, m + extra - {WIDTH - 1} span, m // 8 + 1 step, array_to_string(w[i : i + {WIDTH - 1}], ' ') gram
      from (select *, unnest(range(1, greatest(m - {WIDTH - 2}, 2))) i from tm)
    ),
    d as (select doc_id, [x for x in string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+') if x <> ''] w from documents),
    g as (
      select doc_id, i - 1 p, array_to_string(w[i : i + {WIDTH - 1}], ' ') gram
      from (select *, unnest(range(1, greatest(len(w) - {WIDTH - 2}, 2))) i from d where len(w) > 0)
    ),
    hits as (select doc_id, license, span, step, p, gram from g join tg using (gram)),
    w as (
      select doc_id, license, gram, unnest(range(greatest(cast(ceil((p - span + 1) / step) as bigint), 0), p // step + 1)) * step first_word
      from hits
    ),
    s as (select doc_id, license, first_word, count(distinct gram) shared from w group by all),
    n as (select license, count(*) shingles from tg group by license)
    select doc_id, license, max(shared) shared, shingles, count(*) windows, cast(min(first_word) as bigint) first_word
    from s join n using (license) where shared >= shingles * {LEAST} group by doc_id, license, shingles
    """


@register("op1_license_scan", check_sql())
def op1_license_scan(spark, d):
    return scan(table(spark, d, "documents"))
