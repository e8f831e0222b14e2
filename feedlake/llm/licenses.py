"""License scans: diagonal voting of word k-grams against templates.

Every rolling k-gram of a text's words is hashed and joined to the places where templates have it.
A hit votes for the diagonal word place minus template place; hits of one diagonal lie in step.
Neighbouring diagonals are merged, so that a word too many or too few does not split a match. A merged
span is verified word by word: how many words of the template it holds, against the longer one of
template and span, and that of the words which tell related licences apart it has those of the template, no others.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.scale import materialise

K = 3
DRIFT = 3
COVERED = 0.8
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


class Template(NamedTuple):
    label: str
    words: str
    exact: bool = False  # every k-gram in step, and every place counts


#: Fixed phrases and labels.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
#: Customary wording of license notices.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    *(
        Template(label, words.format(kind))
        for label, kind in (("gpl", "general"), ("lgpl", "lesser general"), ("lgpl", "library general"), ("agpl", "affero general"))
        for words in (
            "licensed under the gnu {} public license",
            "gnu {} public license version",
            "redistribute it and or modify it under the terms of the gnu {} public license as published by",
            "under the terms of the gnu {} public license as published by the free software foundation",
        )
    ),
    *(
        Template(label, " ".join(f"licensed under a creative commons attribution {kind} 4 0 international license".split()))
        for label, *kinds in (
            ("cc-by", ""),
            ("cc-by-sa", "sharealike", "share alike"),
            ("cc-by-nd", "noderivatives", "no derivatives"),
            ("cc-by-nc", "noncommercial", "non commercial"),
            ("cc-by-nc-sa", "noncommercial sharealike", "non commercial share alike"),
            ("cc-by-nc-nd", "noncommercial noderivatives", "non commercial no derivatives"),
        )
        for kind in kinds
    ),
)
#: Words that tell related licences apart.
TELLING = "lesser library affero sharealike alike noncommercial commercial noderivatives noderivs derivatives derivs".split()


def _template_grams(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(template, label, exact, size, own, place, gram) of every k-gram of the templates: a fixed table.

    ``own`` are the telling words that the template has.
    """
    rows = [(i, t.label, t.exact, t.words.split()) for i, t in enumerate(templates)]
    if any(len(words) < K for *_, words in rows):
        raise ValueError(f"a template needs {K} words")
    frame = docs.sparkSession.createDataFrame(rows, "template int, label string, exact boolean, words array<string>")
    grams = F.expr(f"transform(sequence(0, size(words) - {K}), i -> xxhash64({', '.join(f'words[i + {j}]' for j in range(K))}))")
    own = F.array_intersect(F.array(*map(F.lit, TELLING)), "words").alias("own")
    return frame.select("template", "label", "exact", (F.size("words") - K + 1).alias("size"), own, F.posexplode(grams).alias("place", "gram"))


def license_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: tuple[Template, ...] = BASE,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """One row per input row: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base``, ``first_word`` and ``last_word`` count and bound the places where the words of a base
    phrase stand consecutively (words from 0; null without any). ``labels`` adds those of templates
    of whose words a merged span holds four fifths, counted against the longer one of both, and whose telling
    words are those of the span. ``score`` is the best such share of any template. A
    null or empty text has no words: no labels, score 0. Repeated rows are reported alike; null ids
    are passed on; other columns are not read.
    """
    grams = materialise(_template_grams(docs, (*base, *templates)))
    known = [r.gram for r in grams.select("gram").distinct().collect()]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    rows = rows.select("row", "doc_id", F.array_remove(F.split("text", SEPARATORS), "").alias("words"))
    hashes = ", ".join(["w", *(f"words[i + {j}]" for j in range(1, K))])
    rows = rows.withColumn("grams", F.expr(f"transform(slice(words, 1, greatest(size(words) - {K - 1}, 0)), (w, i) -> xxhash64({hashes}))"))
    rows = rows.withColumn("any", F.arrays_overlap("grams", F.array(*map(F.lit, known))))
    placed = F.transform("grams", lambda g, i: F.struct(i.alias("at"), g.alias("gram")))
    hits = F.when(F.col("any"), F.filter(placed, lambda x: x["gram"].isin(known))).otherwise(F.array().cast("array<struct<at:int,gram:bigint>>"))
    worded = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    telling = F.when(F.col("any"), F.filter(worded, lambda x: x["word"].isin(TELLING))).otherwise(F.array().cast("array<struct<at:int,word:string>>"))
    rows = materialise(rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"), telling.alias("telling")))

    votes = rows.select("row", F.inline("hits")).join(F.broadcast(grams), "gram")
    votes = votes.withColumn("diagonal", F.col("at") - F.col("place"))
    lanes = votes.groupBy("row", "template", "label", "exact", "size", "own", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_list("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    places = lanes.where("exact and votes = size").groupBy("row").agg(
        F.count("*").alias("n_base"),
        F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"),
        F.collect_set("label").alias("base"),
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int"), F.lit(0))
    held = F.flatten(F.transform(F.flatten(F.collect_list("places")), lambda p: F.array(*(p + j for j in range(K)))))
    merged = (
        lanes.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(order))
        .groupBy("row", "template", "label", "size", "exact", "own", "span")
        .agg(F.size(F.array_distinct(held)).alias("held"), F.min("first").alias("first"), (F.max("last") + K).alias("end"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
        .withColumn("covered", F.col("held") / F.greatest(F.col("size") + K - 1, F.col("end") - F.col("first")))
    )
    merged = merged.join(rows.where(F.size("telling") > 0).select("row", "telling"), "row", "left")
    # all words where the template would stand, those it does not share too
    inside = F.filter(F.coalesce("telling", F.array().cast("array<struct<at:int,word:string>>")), lambda x: (x["at"] >= F.col("low")) & (x["at"] < F.col("high") + F.col("size") + K - 1))
    inside = F.array_distinct(F.transform(inside, lambda x: x["word"]))
    other = F.sort_array(inside) != F.sort_array("own")
    verified = F.when((F.col("covered") >= COVERED) & ~F.col("exact"), F.col("label"))
    found = merged.where(F.col("exact") | ~other).groupBy("row").agg(F.max("covered").alias("score"), F.collect_set(verified).alias("more"))
    none = F.array().cast("array<string>")
    joined = rows.drop("hits", "telling").join(places, "row", "left").join(found, "row", "left")
    base_labels = F.coalesce("base", none)
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base_labels, F.coalesce("more", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
