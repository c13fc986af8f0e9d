"""License scan by diagonal voting, in DataFrame functions only.

All rolling word pairs of every text are joined by hash to the positions at which license
templates hold them.  A match at text word i and template word j votes for the diagonal
i - j; a diagonal with all of a template's pairs is a verbatim place.  Neighbouring
diagonals of one template (words inserted or left out) merge into a span, as long as its
length fits, and the span is verified by the share of the template's pairs that it covers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import ascii_lower, materialize, order_id, whole_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels that a scan must report.
BASE_PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
# Opening words of public license notices.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


@dataclass(frozen=True)
class Template:
    phrase: str
    label: str
    base: bool


TEMPLATES = [Template(p, x, True) for p, x in BASE_PHRASES] + [Template(p, x, False) for p, x in NOTICES]


def words_of(text: Column) -> Column:
    """Words of a lower-cased text: runs of ASCII digits, a-z and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def template_positions(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(pair, template, tpos, pairs, base, label): one row per word pair of a template."""
    rows = []
    for t, x in enumerate(templates):
        words = x.phrase.split()
        if len(words) < 2:
            raise ValueError(f"a template has at least two words: {x.phrase!r}")
        rows += [(" ".join(words[j : j + 2]), t, j, len(words) - 1, x.base, x.label) for j in range(len(words) - 1)]
    frame = spark.createDataFrame(rows, "tpair string, template int, tpos int, pairs int, base boolean, label string")
    return frame.withColumn("h", F.xxhash64("tpair"))


def license_spans(
    docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text",
    max_shift: int = 3, min_cover: float = 0.7, max_stretch: float = 1.5,
) -> DataFrame:
    """(id, tag, template, label, base, first_word, last_word, cover): verified spans; a base
    phrase has a span for every verbatim place.

    ``id`` is the doc_id (LAST_ID for null) and ``tag`` the text's hash, which tells rows of
    one id apart; rows that repeat both are scanned as one.  A span of another template
    covers at least ``min_cover`` of its pairs within ``max_stretch`` times its length.  Every
    diagonal begins a span, which takes those up to ``max_shift`` beyond its last one that add
    pairs and still fit; of spans that overlap, the best cover (then the shortest, then the
    first) is returned.  Templates have any length.  Null, empty and one-word texts have no
    spans, an empty table has none."""
    text = whole_text(text_col)
    rows = docs.select(order_id(id_col).alias("id"), F.xxhash64(text).alias("tag"), words_of(text).alias("words"))
    pairs = F.zip_with(F.expr("slice(words, 1, greatest(size(words) - 1, 0))"), F.expr("slice(words, 2, greatest(size(words) - 1, 1))"), lambda a, b: F.concat(a, F.lit(" "), b))
    rolled = rows.select("id", "tag", F.posexplode(pairs).alias("pos", "pair")).withColumn("h", F.xxhash64("pair"))
    templates = templates or TEMPLATES
    known = template_positions(docs.sparkSession, templates)  # as long as the templates' texts, given by the caller
    votes = rolled.join(F.broadcast(known), "h").where("pair = tpair")
    diagonals = materialize(
        votes.select("id", "tag", "template", "label", "base", "pairs", "pos", "tpos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .groupBy("id", "tag", "template", "label", "base", "pairs", "diagonal")
        .agg(F.collect_set("tpos").alias("seen"), F.min("pos").alias("lo"), F.max("pos").alias("hi")),
        "diagonals",
    )
    exact = diagonals.where("base and size(seen) = pairs").select(
        "id", "tag", "template", "label", "base", F.col("lo").alias("first_word"), (F.col("hi") + 1).alias("last_word"), F.lit(1.0).alias("cover")
    )
    # a span's length bounds how far apart its diagonals are
    reach = int(max(len(x.phrase.split()) for x in templates) * max_stretch) + 1
    key = ["id", "tag", "template", "label", "base", "pairs"]
    beyond = W.partitionBy("id", "tag", "template").orderBy("diagonal").rangeBetween(0, reach)
    near = diagonals.where("not base").select(*key, F.array_sort(F.collect_list(F.struct("diagonal", "lo", "hi", "seen")).over(beyond)).alias("near"))

    def grown(span: Column, x: Column) -> Column:
        lo, hi, seen = F.least(span["lo"], x["lo"]), F.greatest(span["hi"], x["hi"]), F.array_union(span["seen"], x["seen"])
        fits = (x["diagonal"] - span["diagonal"] <= max_shift) & (hi + 1 - lo <= F.col("pairs") * max_stretch) & (F.size(seen) > F.size(span["seen"]))
        return F.when(fits, F.struct(x["diagonal"].alias("diagonal"), lo.alias("lo"), hi.alias("hi"), seen.alias("seen"))).otherwise(span)

    span = F.aggregate(F.expr("slice(near, 2, size(near))"), F.get("near", F.lit(0)), grown)
    spans = near.select(*key, span.alias("s")).select(
        *key, F.col("s.lo").alias("first_word"), (F.col("s.hi") + 1).alias("last_word"), (F.size("s.seen") / F.col("pairs")).alias("cover")
    ).where((F.col("cover") >= min_cover) & (F.col("last_word") - F.col("first_word") <= F.col("pairs") * max_stretch))
    order = W.partitionBy("id", "tag", "template").orderBy("first_word", "last_word")
    clear = F.col("first_word") > F.max("last_word").over(order.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("clear", F.coalesce(clear, F.lit(False)).cast("int")).withColumn("island", F.sum("clear").over(order))
    merged = islands.groupBy("id", "tag", "template", "label", "base", "island").agg(
        F.min(F.struct((-F.col("cover")).alias("c"), (F.col("last_word") - F.col("first_word")).alias("long"), "first_word", "last_word", "cover")).alias("best")
    ).select("id", "tag", "template", "label", "base", "best.first_word", "best.last_word", "best.cover")
    return exact.unionByName(merged)


def license_scan(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score).

    n_base counts all verbatim places of base phrases, first_word and last_word are their
    smallest and largest start (null without any), labels add those of verified notices, score
    is the best cover (0 without any).  Null and empty texts have no words and no places."""
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), order_id(id_col).alias("id"), F.xxhash64(text).alias("tag"),
        F.size(words_of(text)).cast("long").alias("n_words"),
    )
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))  # noqa: E731  labels: a fixed list
    own = license_spans(docs, templates, id_col, text_col).groupBy("id", "tag").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).cast("long").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("cover").alias("score"),
    )
    return rows.join(own, ["id", "tag"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
