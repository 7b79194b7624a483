"""License statements in texts, by MinHash bands over windows, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import ROW_KEY, row_key, settle

_MOST_SHINGLES = 20_000

# License statements as they are published (fixed values).
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use '
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            'software and associated documentation files (the "Software"), to deal in the Software '
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met: "
                     "Redistributions of source code must retain the above copyright notice, this "
                     "list of conditions and the following disclaimer."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case; null texts have none."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(found, lambda w: w != "")


def _shingle_starts(words: Column, width: int) -> Column:
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _shingle(words: Column, start: Column, width: int) -> Column:
    return F.xxhash64(F.slice(words, start + 1, width))


def _template_shingles(templates: DataFrame, width: int, text: str, name: str) -> DataFrame:
    """``(template, license, stride, size, shingles)``; one row each, shingles distinct.

    ``stride`` is the least power of two that is not below ``size``.
    """
    words = words_of(F.col(text).cast("string"))
    rows = templates.select(F.col(name).cast("string").alias("license"), words.alias("_words"))
    hashes = F.array_distinct(F.transform(
        _shingle_starts(F.col("_words"), width), lambda i: _shingle(F.col("_words"), i, width)
    ))
    return rows.select("license", F.array_sort(hashes).alias("shingles")).where(
        F.col("license").isNotNull() & (F.size("shingles") > 0)
    ).distinct().select(
        F.xxhash64("license", "shingles").alias("template"), "license", "shingles",
        F.size("shingles").alias("size"),
        F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles").cast("double")))).cast("int")
        .alias("stride"),
    )


def _bands(shingles: Column, bands: int, rows: int) -> Column:
    """Band hashes of a set of shingles: ``rows`` minima each."""
    def least(number: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(number))))

    return F.array(*[
        F.xxhash64(F.lit(band), *[least(band * rows + row) for row in range(rows)])
        for band in range(bands)
    ])


def collision_chance(similarity: float, bands: int, rows: int) -> float:
    """How likely two sets of that Jaccard similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def find_licenses(docs: DataFrame, templates: DataFrame | None = None, containment: float = 0.8,
                  width: int = 5, bands: int = 48, rows: int = 1, doc_id: str = "doc_id",
                  text: str = "text", template_text: str = "text",
                  license_name: str = "license") -> DataFrame:
    """``(doc_id, licenses)`` of every row: sorted names of the licenses it states.

    A license is stated where a window of the text holds at least ``containment``
    of the distinct ``width``-word shingles of one of its templates.

    Only shingles that some template has can count, so a text is first reduced to
    these and their places. For templates of up to s shingles, s a power of two,
    windows of 2s places start at every s-th place, so each stretch of s places is
    inside one. Such a window holds no more than 2s shingles and the template more
    than s/2, so wherever enough is contained the similarity is over
    ``containment / 4``, and the default 48 bands of one minimum each meet with a chance
    of 0.99998 at least. What meets is verified on the shingles themselves.

    Null and empty texts and templates of fewer than ``width`` words state nothing.
    Templates are few: more than ``_MOST_SHINGLES`` shingles are an error. Repeated
    rows stay repeated. Texts never travel, only their hits.
    """
    spark = docs.sparkSession
    templates = default_templates(spark) if templates is None else templates
    kept = settle(_template_shingles(templates, width, template_text, license_name), "templates")
    pairs = kept.select("stride", F.explode("shingles").alias("shingle")).distinct()
    known = pairs.select("shingle").distinct().limit(_MOST_SHINGLES + 1).collect()
    if len(known) > _MOST_SHINGLES:
        raise ValueError(f"templates have more than {_MOST_SHINGLES} shingles")
    hashes = [r.shingle for r in known]

    words = F.col("_words")
    places = F.filter(_shingle_starts(words, width),
                      lambda i: _shingle(words, i, width).isin(hashes)
                      if hashes else F.lit(False))
    hits = settle(
        docs.select(F.col(doc_id).alias("doc_id"), *row_key(doc_id, text),
                    words_of(F.col(text).cast("string")).alias("_words"))
        .select("doc_id", *ROW_KEY, F.transform(places, lambda i: F.struct(
            i.alias("place"), _shingle(words, i, width).alias("shingle"))).alias("hits")),
        "license-hits",
    )
    placed = hits.where(F.size("hits") > 0).select(*ROW_KEY, F.explode("hits").alias("_h")).select(
        *ROW_KEY, "_h.*")
    step = F.floor(F.col("place") / F.col("stride"))
    windows = (
        placed.join(F.broadcast(pairs), "shingle")
        .withColumn("window", F.explode(F.array(step, step - 1)))
        .groupBy(*ROW_KEY, "stride", "window")
        .agg(F.collect_set("shingle").alias("held"))
    )
    retrieved = (
        windows.withColumn("band", F.explode(_bands(F.col("held"), bands, rows)))
        .join(F.broadcast(kept.select(
            "template", "stride", F.explode(_bands(F.col("shingles"), bands, rows)).alias("band")
        )), ["stride", "band"])
        .select(*ROW_KEY, "stride", "window", "held", "template").distinct()
    )
    verified = retrieved.join(
        F.broadcast(kept.select("template", "license", "size", "shingles")), "template"
    ).where(F.size(F.array_intersect("held", "shingles")) >= F.col("size") * containment)
    stated = settle(
        verified.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set("license")).alias("licenses")),
        "stated-licenses",
    )
    return hits.select("doc_id", *ROW_KEY).join(stated, ROW_KEY, "left").select(
        "doc_id", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses")
    )
