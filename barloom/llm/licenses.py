"""Licences named or quoted in a text, by a positional index of their rarest words.

Each template is a known wording with a label and a mandatory key phrase. How rare its words are is
counted over all texts, and a template is looked up by the words of its key phrase that have the
highest inverse document frequency, one for every ``WORDS_PER_LOOKUP``. A text's words that are
lookups give, through the index's postings, the places where a template would have to begin; places
named alike by several lookups are one. At each place the other words of the template are compared at
their relative positions, and the key phrase must stand there in full. The part of the template's
weight that was found is the score; it removes no place, so a key phrase decides alone and is long
enough for that. A template with several key phrases is listed once for each.

No place is missed: where the key phrase stands, so do its lookups.
Everything is an expression over one row; only the word counts are an aggregation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ascii_lower

WORDS_PER_LOOKUP = 6

# Phrases that name a licence, as (label, words).
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
# Wordings of licence notices, as (label, words, mandatory key phrase).
NOTICES = [
    ("apache", "you may not use this file except in compliance with the license", "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation", "you can redistribute it and or modify"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", "and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", "permission is hereby granted free of charge"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case; none for null."""
    spaced = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    plain = F.trim(spaced)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def weights(texts: DataFrame, words: str, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency over all rows of each word of the templates; their number bounds the result."""
    held = F.array_intersect(words, F.array(*(F.lit(w) for w in vocabulary)))
    # The empty word stands for the row itself.
    counted = texts.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counted.collect()}
    rows = found.get("", 0)
    # A word that no text holds weighs as much as one that a single text holds.
    return {w: math.log((1 + rows) / (1 + max(1, found.get(w, 0)))) + 1e-3 for w in vocabulary}


def templates() -> list[tuple[str, list[str], int, int, bool]]:
    """(label, words, start and end of the key phrase, whether the label's own name)."""
    out = [(label, phrase.split(), 0, len(phrase.split()), True) for label, phrase in PHRASES]
    for label, text, key in NOTICES:
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        out.append((label, words, at, at + len(phrase), False))
    return out


def lookups(words: list[str], start: int, end: int, idf: dict[str, float]) -> list[int]:
    """Places of the rarest words of a template's key phrase; the first of equally rare ones."""
    ranked = sorted(range(start, end), key=lambda i: (-idf[words[i]], i))
    return ranked[: -(-len(ranked) // WORDS_PER_LOOKUP)]


def license_places(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words long and ``places``: array<struct<label, base boolean, start long, share double>>.

    ``start`` is the word the wording begins at, from 0. Null and empty texts have no words and no
    places. Repeated rows are treated alike. Columns of these names are replaced.
    """
    known = templates()
    vocabulary = sorted({w for _, words, *_ in known for w in words})
    read = df.withColumn("_llm_words", words_of(F.col(text)))
    idf = weights(read, "_llm_words", vocabulary)
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, (_, words, start, end, _) in enumerate(known):
        for place in lookups(words, start, end, idf):
            postings.setdefault(words[place], []).append((number, place))

    def texts(values: list[str]) -> Column:
        return F.array(*(F.lit(v) for v in values))

    index = F.create_map(*(
        item
        for word, places in postings.items()
        for item in (F.lit(word), F.array(*(F.struct(F.lit(n).alias("number"), F.lit(p).alias("at")) for n, p in places)))
    ))
    all_words = F.array(*(texts(words) for _, words, *_ in known))
    all_weights = F.array(*(F.array(*(F.lit(idf[w]) for w in words)) for _, words, *_ in known))
    all_keys = F.array(*(F.array(F.lit(a), F.lit(b)) for _, _, a, b, _ in known))
    labels, bases = texts([k[0] for k in known]), F.array(*(F.lit(k[4]) for k in known))

    words = F.col("_llm_words")
    rare = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(*postings))
    named = F.flatten(F.transform(rare, lambda i: F.transform(
        F.element_at(index, F.get(words, i)), lambda p: F.struct(p["number"].alias("number"), (i - p["at"]).alias("start"))
    )))

    def stands(place: Column, i: Column) -> Column:
        at = place["start"] + i
        return (at >= 0) & F.coalesce(F.get(words, F.greatest(at, F.lit(0))) == F.get(F.get(all_words, place["number"]), i), F.lit(False))

    def share(place: Column) -> Column:
        weight = F.get(all_weights, place["number"])
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
        return F.round(total(F.transform(weight, lambda w, i: F.when(stands(place, i), w).otherwise(0.0))) / total(weight), 6)

    def verified(place: Column) -> Column:
        key = F.get(all_keys, place["number"])
        return F.forall(F.sequence(F.get(key, F.lit(0)), F.get(key, F.lit(1)) - 1), lambda i: stands(place, i))

    found = F.filter(F.array_distinct(named), verified)
    scored = F.transform(found, lambda p: F.struct(
        F.get(labels, p["number"]).alias("label"), F.get(bases, p["number"]).alias("base"),
        p["start"].cast("long").alias("start"), share(p).alias("share"),
    ))
    # One place for a template found by several of its key phrases.
    scored = F.array_distinct(scored)
    empty = F.array().cast("array<struct<label:string,base:boolean,start:bigint,share:double>>")
    out = read.withColumn("n_words", F.size(words).cast("long"))
    # Most texts hold no lookup; they skip the rest.
    return out.withColumn("places", F.when(F.arrays_overlap(words, texts(list(postings))), scored).otherwise(empty)).drop("_llm_words")


def licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the summary of ``license_places``: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    out = license_places(df, text)
    base = F.filter("places", lambda p: p["base"])
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")
    return out.withColumns({
        "n_base": F.size(base).cast("long"),
        "first_word": F.array_min(base["start"]),
        "last_word": F.array_max(base["start"]),
        "base_labels": joined(base),
        "labels": joined(F.col("places")),
        "score": F.coalesce(F.array_max(F.col("places")["share"]), F.lit(0.0)),
    })
