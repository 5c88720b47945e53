"""License scans: text blocks against license templates by Dice coefficient over word bigrams, in DataFrame operations only.

A block is a line, or a paragraph (between blank lines) of several lines.  Blocks are normalised (small letters, runs of anything but letters and
digits to one space) and become sets of hashed word bigrams.  Dice >= t needs |A| t / (2 - t) <= |B| <= |A| (2 - t) / t, so
blocks outside all templates' bounds go first, and each block meets only the templates whose bounds hold it.  Notices inside
longer blocks are found by windows of each template's number of words over the whole text, in texts that hold enough of its bigrams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K

#: Fixed values: SPDX identifiers and their notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Notices that the ones above would be taken for.
MORE_TEMPLATES = (
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)
SIMILARITY = 0.8


def normalise(column):
    return F.btrim(F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def bigrams(column):
    """Distinct hashed word bigrams of a normalised text; fewer than two words have none."""
    pairs = lambda w: F.array_distinct(F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.xxhash64(a, b)))  # noqa: E731
    # the words are bound by a transform of one element, so that they are split once
    return F.get(F.transform(F.array(F.split(column, " ")), lambda w: F.when(F.size(w) > 1, pairs(w)).otherwise(F.array().cast("array<bigint>"))), F.lit(0))


def _template_table(spark, templates) -> list[tuple[int, str, list[int]]]:
    """(number, license, bigrams); the templates are part of the code, so this is small whatever the input."""
    rows = [f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(templates)]
    table = spark.sql(f"select * from values {', '.join(rows)} as t(number, license, text)")
    return [(r.number, r.license, list(r.grams)) for r in table.select("number", "license", bigrams(normalise(F.col("text"))).alias("grams")).collect()]


def scan(docs: DataFrame, templates=TEMPLATES, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, block, license, template, dice): the best template of every block that reaches `similarity`.

    block: a line's number from 0, or "p" and a paragraph's number.  Ties go to the first template of the list.  Null or empty texts have no blocks; equal rows each give their own; an id that is null is
    returned as null; an empty table gives no rows.
    """
    known = _template_table(docs.sparkSession, templates)
    low, high = similarity / (2 - similarity), (2 - similarity) / similarity
    sizes = [len(g) for _, _, g in known]
    lines = F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "\n")
    single = F.transform(lines, lambda line, i: F.struct(i.cast("string").alias("block"), line.alias("text")))
    paragraphs = F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"\n[ \t\r\x0b\x0c]*\n")
    named = F.transform(paragraphs, lambda p, i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("block"), p.alias("text")))
    several = F.filter(named, lambda b: F.contains(b["text"], F.lit("\n")))
    least, most = low * min(sizes), high * max(sizes)
    gram_sets = F.transform(F.concat(single, several), lambda b: F.struct(b["block"].alias("block"), bigrams(normalise(b["text"])).alias("grams")))
    fitting = F.filter(gram_sets, lambda b: F.size(b["grams"]).between(least, most))
    # generators keep Catalyst from evaluating the sets again in every predicate above them
    blocks = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(fitting).alias("b")).select("id", "b.block", F.col("b.grams").alias("grams"))
    n, candidates = F.size("grams"), []
    for number, name, grams in known:
        held = n.between(low * len(grams), high * len(grams))
        both = F.size(F.array_intersect("grams", F.array(*(F.lit(g) for g in grams))))
        dice = F.when(held, 2.0 * both / (n + len(grams)))
        candidates.append(F.struct(dice.alias("dice"), F.lit(-number).alias("order"), F.lit(name).alias("license")))
    reached = F.filter(F.array(*candidates), lambda c: c["dice"] >= similarity)
    found = blocks.select("id", "block", F.explode(F.slice(F.sort_array(reached, asc=False), 1, 1)).alias("best"))
    return found.select(F.col("id").alias(id_col), "block", "best.license", (-F.col("best.order")).alias("template"), "best.dice")


def _inside(docs: DataFrame, templates, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(id, key, block, license, template, dice): each license's best window of a text; block is "w" and the window's first word."""
    known = _template_table(docs.sparkSession, templates)
    ordered = lambda w: F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.xxhash64(a, b))  # noqa: E731
    words = F.split(normalise(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), " ")
    every = F.array(*(F.lit(g) for g in sorted({g for _, _, grams in known for g in grams})))
    grams = F.transform(F.array(words), lambda w: F.when(F.size(w) > 1, ordered(w)).otherwise(F.array().cast("array<bigint>")))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("key"), F.explode(grams).alias("grams"))
    texts = texts.select("id", "key", "grams", F.explode(F.array(F.array_intersect("grams", every))).alias("held"))
    least, tries = similarity / (2 - similarity), []
    for number, name, own in known:
        t = F.array(*(F.lit(g) for g in own))
        tries.append(F.when(F.size(F.array_intersect("held", t)) >= least * len(own), F.struct(F.lit(number).alias("number"), F.lit(name).alias("license"), t.alias("own"))))
    hopeful = texts.filter(F.size("held") > 0).select("id", "key", "grams", F.explode(F.array_compact(F.array(*tries))).alias("t"))
    n = F.size("t.own")
    starts = F.sequence(F.lit(1), F.greatest(F.size("grams") - n + 1, F.lit(1)))
    spots = hopeful.select("id", "key", "t", F.explode(F.transform(starts, lambda i: F.struct(i.alias("at"), F.array_distinct(F.slice("grams", i, n)).alias("grams")))).alias("w"))
    dice = 2.0 * F.size(F.array_intersect("w.grams", "t.own")) / (F.size("w.grams") + n)
    rank = F.struct(dice.alias("dice"), (-F.col("t.number")).alias("order"), (1 - F.col("w.at")).alias("back"))
    reached = spots.select("id", "key", F.col("t.license").alias("license"), (F.col("w.at") - 1).alias("at"), n.alias("n"), rank.alias("b")).filter(F.col("b.dice") >= similarity)
    # of windows that overlap, the best; lists are bounded by the templates' lengths
    longest = max(len(grams) for _, _, grams in known)
    near = Window.partitionBy("id", "key").orderBy("at").rangeBetween(-longest, longest)
    reached = reached.withColumn("others", F.collect_set(F.struct("at", "n", "b")).over(near))
    top = reached.filter(~F.exists("others", lambda o: (o["at"] <= F.col("at") + F.col("n")) & (F.col("at") <= o["at"] + o["n"]) & (o["b"] > F.col("b"))))
    top = top.groupBy("id", "key", "license").agg(F.max("b").alias("b"))
    return top.select("id", "key", F.concat(F.lit("w"), (-F.col("b.back")).cast("string")).alias("block"), "license", (-F.col("b.order")).alias("template"), "b.dice")


def scan_all(docs: DataFrame, templates=TEMPLATES + MORE_TEMPLATES, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of scan(), and for licenses that no block of a text has, the best window of that text (block "w" and its first word).

    Rows with equal ids and texts share one such row.
    """
    own = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("key")).alias("of"), F.col(f"`{text_col}`").alias("text"))
    blocks = K.stored(scan(own, templates, similarity, "of", "text").select("of.id", "of.key", "block", "license", "template", "dice"), "blocks")
    windows = _inside(docs, templates, similarity, id_col, text_col)
    seen = blocks.select(F.col("id").alias("id2"), F.col("key").alias("key2"), F.col("license").alias("license2")).distinct()
    new = windows.join(seen, F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2")) & (F.col("license") == F.col("license2")), "left_anti")
    return blocks.unionByName(new).select(F.col("id").alias(id_col), "block", "license", "template", "dice")


def query(spark, sf_dir):
    return scan_all(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle_sql(templates=TEMPLATES, similarity: float = SIMILARITY) -> str:
    rows = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(templates))
    grams = "case when len(w) > 1 then list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) else [] end"
    norm = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    return rf"""
with t as (select number, license, {grams} as g from (select number, license, {norm.format("text")} as w from (values {rows}) as v(number, license, text))),
lines as (select doc_id, (i - 1)::varchar as block, l[i] as text from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents), unnest(range(1, len(l) + 1)) as u(i)),
paragraphs as (select doc_id, 'p' || (i - 1)::varchar as block, l[i] as text
 from (select doc_id, regexp_split_to_array(coalesce(text, ''), '
[ 	
]*
') as l from documents), unnest(range(1, len(l) + 1)) as u(i) where contains(l[i], chr(10))),
blocks as (select doc_id, block, {grams} as g from (select doc_id, block, {norm.format("text")} as w from (select * from lines union all select * from paragraphs))),
pairs as (select doc_id, block, license, number, 2.0::double * len(list_intersect(blocks.g, t.g)) / (len(blocks.g) + len(t.g)) as dice
 from blocks join t on len(blocks.g) between {similarity / (2 - similarity)!r}::double * len(t.g) and {(2 - similarity) / similarity!r}::double * len(t.g)),
ranked as (select *, row_number() over (partition by doc_id, block order by dice desc, number) as k from pairs where dice >= {similarity})
select doc_id, block, license, number as template, dice from ranked where k = 1"""


ORACLE = oracle_sql()
