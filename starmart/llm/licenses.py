"""License scan by a positional index of rare words, in DataFrame operations only.

Each template has a key phrase that must stand in the file word by word. The two words of that phrase with the
highest inverse document frequency in the corpus are its postings (word, template, place in the
template). A file with the phrase has all its words, so these two are its own rarest licence words of that phrase too, and a file
without them costs nothing. A file's occurrences of such words are looked up there; places where all postings of a template
meet at one relative position are candidates. Of these the key phrase is verified, and the share of the template's
idf that stands in place is the score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import staged

# Label, key phrase, whole template, whether its label is a base label.
TEMPLATES = (
    ("cc-by", "cc by", "cc by", True),
    ("gpl", "general public license", "general public license", True),
    ("reserved", "all rights reserved", "all rights reserved", True),
    ("mit", "mit license", "released under the mit license", False),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy", False),
    ("apache", "apache license", "licensed under the apache license version 2 0", False),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification", False),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0", False),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0", False),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0", False),
    ("cc0", "cc0 1 0", "cc0 1 0 universal", False),
    ("creative-commons", "creative commons attribution", "licensed under a creative commons attribution", False),
    ("gpl-3", "gnu general public license version 3", "licensed under the gnu general public license version 3", False),
    ("gpl-2", "gnu general public license version 2", "licensed under the gnu general public license version 2", False),
    ("lgpl", "lesser general public license", "gnu lesser general public license", False),
    ("agpl", "affero general public license", "gnu affero general public license", False),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license", False),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain", False),
    ("epl", "eclipse public license", "eclipse public license", False),
    ("boost", "boost software license", "boost software license version 1 0", False),
    # Sentences of licence bodies, for files that give no title.
    ("mit", "to deal in the software without restriction", "to deal in the software without restriction including without limitation the rights", False),
    ("mit", "copyright notice and this permission notice shall be included", "the above copyright notice and this permission notice shall be included in all", False),
    ("mit", "the software is provided as is without warranty", "the software is provided as is without warranty of any kind express or", False),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose", False),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source code must retain the above copyright notice this list of", False),
    ("bsd", "nor the names of its contributors may be used", "nor the names of its contributors may be used to endorse or promote", False),
    ("bsd", "this software is provided by the copyright holders and contributors", "this software is provided by the copyright holders and contributors as is", False),
    ("apache", "you may not use this file except in compliance", "you may not use this file except in compliance with the license", False),
    ("zlib", "this software is provided as is without any express or implied warranty", "this software is provided as is without any express or implied warranty", False),
    ("gnu", "you can redistribute it and or modify it under the terms", "you can redistribute it and or modify it under the terms of the", False),
    ("gnu", "hope that it will be useful but without any warranty", "in the hope that it will be useful but without any warranty", False),
    ("mpl", "if a copy of the mpl was not distributed with this file", "if a copy of the mpl was not distributed with this file", False),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute", "anyone is free to copy modify publish use compile sell or distribute this", False),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", "unauthorized copying of this file via any medium is strictly prohibited", False),
)
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = max(len(text.split()) for _, _, text, _ in TEMPLATES)
VOCABULARY = sorted({word for _, _, text, _ in TEMPLATES for word in text.split()})


def lowered(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def words_of(text: Column) -> Column:
    """Words of ASCII letters, digits and all other characters beyond ASCII, as they are written."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATOR), lambda w: w != "")


def inverse_frequencies(words: DataFrame) -> DataFrame:
    """word, idf of the template words, counted over all rows with an array column `words`."""
    rows = words.select(
        F.explode(F.array_append(F.array_intersect(F.transform("words", lowered), F.array(*map(F.lit, VOCABULARY))), F.lit(""))).alias("word")
    )
    counts = rows.groupBy("word").agg(F.count("*").alias("df"))
    spark = words.sparkSession
    known = spark.createDataFrame([(w,) for w in ["", *VOCABULARY]], "word string")
    full = known.join(counts, "word", "left").select("word", F.coalesce("df", F.lit(0)).alias("df"))
    total = F.max(F.when(F.col("word") == "", F.col("df"))).over(Window.partitionBy())
    return full.withColumn("total", total).where("word <> ''").select(
        "word", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf")
    )


def index(idf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Templates (nth, label, base, words, weights, key_from, key_size) and postings (word, of, place, needed)."""
    spark = idf.sparkSession
    rows = []
    for nth, (label, key, text, base) in enumerate(TEMPLATES):
        words, wanted = text.split(), key.split()
        key_from = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        rows.append((nth, label, base, words, key_from, len(wanted)))
    templates = spark.createDataFrame(rows, "nth int, label string, base boolean, words array<string>, key_from int, key_size int")
    placed = templates.select("nth", "key_from", "key_size", F.posexplode("words").alias("place", "word")).join(idf, "word")
    weights = placed.groupBy("nth").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "idf"))), lambda x: x["idf"]).alias("weights"))
    in_key = placed.where((F.col("place") >= F.col("key_from")) & (F.col("place") < F.col("key_from") + F.col("key_size")))
    rarest = Window.partitionBy("nth").orderBy(F.col("idf").desc(), "place")
    postings = in_key.withColumn("rank", F.row_number().over(rarest)).where("rank <= 2").select("word", F.col("nth").alias("of"), "place", F.least("key_size", F.lit(2)).alias("needed"))
    return templates.join(weights, "nth"), postings


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per input row.

    A null or empty text has no words and no labels, and the score 0. Rows with equal or null ids are kept apart. Other columns are
    ignored. `score` is the best among a row's labelled places; other templates than the base ones need `least`.
    """
    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    idf = staged(inverse_frequencies(words), "license-idf")
    templates, postings = (staged(x, "license-index") for x in index(idf))
    rare = [row["word"] for row in postings.select("word").distinct().collect()]  # two words per template at most
    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.lower(F.get("words", i)).isin(rare))
    around = lambda i: F.struct(
        i.alias("at"),
        lowered(F.get("words", i)).alias("word"),
        F.greatest(i - LONGEST, F.lit(0)).alias("begin"),
        F.transform(F.slice("words", F.greatest(i - LONGEST, F.lit(0)) + 1, F.lit(2 * LONGEST + 1)), lowered).alias("near"),
    )
    found = staged(
        words.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.when(F.size("words") > 0, F.transform(spots, around)).alias("spots"),
        ),
        "license-words",
    )
    looked_up = (
        found.select("row", F.explode("spots").alias("spot"))
        .select("row", "spot.*")
        .join(F.broadcast(postings), "word")
        .withColumn("start", F.col("at") - F.col("place"))
        .groupBy("row", "of", "start")
        .agg(F.count("*").alias("votes"), F.first("needed").alias("needed"), F.min_by(F.struct("begin", "near"), "at").alias("context"))
        .where(F.col("votes") >= F.col("needed"))
    )
    same = lambda k: F.coalesce(F.get("context.near", F.col("start") + k - F.col("context.begin")) == F.get("words", k), F.lit(False))
    verified = (
        looked_up.join(F.broadcast(templates), F.col("of") == F.col("nth"))
        .where(F.forall(F.sequence("key_from", F.col("key_from") + F.col("key_size") - 1), same))
        .withColumn(
            "held",
            F.aggregate(F.sequence(F.lit(0), F.size("words") - 1), F.lit(0.0), lambda total, k: total + F.when(same(k), F.get("weights", k)).otherwise(0.0))
            / F.aggregate("weights", F.lit(0.0), lambda total, w: total + w),
        )
        .where(F.col("base") | (F.col("held") >= least))
    )
    per_row = verified.groupBy(F.col("row").alias("of_row")).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.least(F.lit(1.0), F.max("held")).alias("score"),
    )
    return found.select("row", "doc_id", "n_words").join(per_row, F.col("row") == F.col("of_row"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
