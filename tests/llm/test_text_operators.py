"""Decontamination, licences, language and tokens against brute force and on odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from barloom.llm import bpe, decontamination, language, licenses
from barloom.llm.queries import QUERIES, byte_vocabulary

from .conftest import ODD, SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def hits(text, items):
    """Hit word places and item ids, window by window."""
    doc, places, found = words(text), set(), set()
    at = {}
    for i in range(len(doc)):
        at.setdefault(doc[i], []).append(i)
    for item, passage in items:
        w = words(passage)
        for start in range(max(1, len(w) - 9) if w else 0):
            window = w[start : start + 10]
            for i in at.get(window[0], []):
                if doc[i : i + len(window)] == window:
                    places |= set(range(i, i + len(window)))
                    found |= set() if item is None else {str(item)}
    return len(doc), places, found


def digest(found):
    return hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_decontamination_equals_brute_force(spark, rows):
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    got = QUERIES["op1_decontamination"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n, places, found = hits(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, len(places), len(found), digest(found))
        assert r["contaminated"] == bool(places)
    assert any(r["contaminated"] for r in got)


def test_decontamination_spans_point_into_the_original(spark):
    passage = "Ünder the Öld bridge, twelve quiet words stand in a ROW for testing"
    docs = spark.createDataFrame([(1, f"é start -- {passage.upper()}!! end"), (2, "nothing here")], "doc_id long, text string")
    docs = docs.replace(passage.upper(), passage)
    items = spark.createDataFrame([(5, passage.replace("Ü", "Ü")), (6, "two words")], "item_id long, text string")
    text = f"é start -- {passage}!! end, two  WORDS."
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    first, second = decontamination.contaminated(docs, items).orderBy("doc_id").collect()
    assert [text[s["begin"] : s["stop"]] for s in first["hit_spans"]] == [passage, "two  WORDS"]
    assert first["hit_items"] == ["5", "6"]
    assert second["hit_spans"] == [] and not second["contaminated"]


def test_decontamination_overlaps_blocks_and_odd_items(spark, odd):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(25)]
    items += [(None, "a b a b a b"), (77, None), (78, "..."), items[0]]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    given = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontamination.BLOCK_WORDS, 40):
        for r in decontamination.contaminated(docs, given, block_words=size).collect():
            n, places, found = hits(r["text"], [i for i in items if i[1]])
            assert (r["n_words"], r["n_hit"], r["hit_items"]) == (n, len(places), sorted(found))
    out = decontamination.contaminated(odd, given)
    assert out.count() == len(ODD)
    assert {r["n_words"] for r in out.where("text is null or text = ''").collect()} == {0}
    assert decontamination.contaminated(odd, given.limit(0)).where("contaminated").count() == 0
    assert decontamination.contaminated(odd.limit(0), given).count() == 0
    kept = decontamination.clean(odd, given)
    assert kept.columns == odd.columns and {r["found"] for r in kept.collect()} == {"x"}


def base_places(text):
    doc, phrases = words(text), {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    out = []
    for phrase, label in phrases.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(doc)) if doc[i : i + len(p)] == p]
    return len(doc), sorted(out)


def same_licences(r, text):
    n, places = base_places(text)
    labels = {label for _, label in places}
    assert (r["n_words"], r["n_base"]) == (n, len(places))
    assert r["first_word"] == (places[0][0] if places else None)
    assert r["last_word"] == (places[-1][0] if places else None)
    assert r["base_labels"] == ",".join(sorted(labels))
    assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert r["labels"] == ",".join(sorted(set(filter(None, r["labels"].split(",")))))


def test_licences_equal_brute_force(spark, rows, odd):
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    got = QUERIES["op2_licenses"](spark, SMALL).collect()
    assert len(got) == len(texts) and any(r["n_base"] for r in got)
    for r in got:
        same_licences(r, texts[r["doc_id"]])
    rng = random.Random(5)
    bag = ["mit", "license", "apache", "general", "public", "gnu", "lesser", "x", "License,", "MIT"]
    data = [(i, " ".join(rng.choice(bag) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    for r in licenses.licenses(spark.createDataFrame(data, "doc_id long, text string")).collect():
        same_licences(r, r["text"])
    out = licenses.licenses(odd).collect()
    assert len(out) == len(ODD)
    for r in out:
        same_licences(r, r["text"])
    assert licenses.licenses(odd.limit(0)).count() == 0


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("GNU Lesser General Public License", "gpl,lgpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Permission is granted to any person obtaining a copy of this software and documentation", ""),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that", "bsd"),
    ("a license of the public", ""),
])
def test_licence_notices(spark, text, labels):
    docs = spark.createDataFrame([(1, "Intro words. " + text), (2, "plain words and nothing else")], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.licenses(docs).collect()}
    assert got == {1: labels, 2: ""}


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under the Mozilla Public License", "mpl"),
    ("Redistribution and use in source and binary forms are permitted provided that the notice stays", "bsd"),
    ("This library is free software; you can redistribute it and/or modify it under the same terms", "gpl"),
    ("used except in compliance with the License", "apache"),
    ("and/or distribute this software for any purpose", "isc"),
    ("Permission is hereby granted, free of charge", "mit"),
    ("free and unencumbered software", "unlicense"),
    ("unencumbered software released into the public domain", "unlicense"),
    ("patent-unencumbered software is preferred", ""),
])
def test_licence_key_phrases_decide_alone(spark, text, labels):
    docs = spark.createDataFrame([(1, text), (2, "plain words and nothing else")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.licenses(docs).collect()}
    assert {k: r["labels"] for k, r in got.items()} == {1: labels, 2: ""}
    assert (0 < got[1]["score"] <= 1) == bool(labels)


def test_licence_found_by_two_key_phrases_is_one_place(spark):
    text = "This is free and unencumbered software released into the public domain."
    places = licenses.license_places(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["places"]
    assert [(p["label"], p["start"], p["share"]) for p in places] == [("unlicense", 0, 1.0)]


def test_language_on_held_out_documents(spark, rows):
    truth = {r["doc_id"]: r for r in rows("documents")}
    got = QUERIES["op7_language"](spark, SMALL).collect()
    assert len(got) == len(truth)
    known = {r["lang"] for r in truth.values()}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in known and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 20 and right >= 0.97 * len(held)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SMALL}/documents.parquet'").fetchall()
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    changed = [(k, "zzz qqq" if held(k) else t, "xx" if held(k) else v) for k, t, v in docs]
    one, other = (
        language.fit_documents(spark.createDataFrame(d, "doc_id long, text string, lang string")) for d in (docs, changed)
    )
    assert one.languages == other.languages
    assert np.array_equal(one.centroids, other.centroids) and np.array_equal(one.floors, other.floors)


def test_language_centroids_are_kinds_of_text_and_not_odd_texts():
    rng = np.random.default_rng(3)
    kinds = [["harbour", "vessel", "cargo", "anchor", "sailor", "deck"], ["quotient", "matrix", "kernel", "algebra", "ring", "field"]]
    texts = [" ".join(rng.choice(kind, 80)) for kind in kinds for _ in range(100)] + ["A.", "Re.", "Zz.", "Qx."]
    raw = np.stack([language.counts(t) for t in texts])
    points = language.Model([], raw, raw, np.ones(language.DIMENSIONS, dtype=np.float32)).unit(raw)
    found = language.clusters(points, raw.sum(axis=1), 4)
    nearest = (points @ found.T).argmax(axis=1)
    assert np.bincount(nearest, minlength=len(found)).min() >= 4
    assert not set(nearest[:100]) & set(nearest[100:200])


def test_language_rejects_what_is_no_language_short_or_long(spark):
    more = SMALL.replace("sf0.001", "sf0.01")  # with a hundred texts of most languages
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    junk = ["xkcd qwrtz vbnm jjjq"] + [" ".join(word() for _ in range(n)) for n in (4, 8, 40, 150, 600, 1500)]
    junk += [" ".join(f"{rng.getrandbits(32):08x}" for _ in range(n)) for n in (8, 30, 100, 400)]
    docs = spark.read.parquet(f"{more}/documents.parquet")
    data = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(junk)]
    added = spark.createDataFrame(data, docs.schema)
    left = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs.unionByName(added), more).collect()}
    assert not [t for i, t in enumerate(junk) if -1 - i in left]
    spoken = [r["doc_id"] for r in docs.collect() if r["text"] and r["lang"] and language.has_letter(r["text"])]
    assert len(set(spoken) - left) <= 0.01 * len(spoken)


def test_language_weights_are_of_all_labelled_rows(spark):
    data = [("one common text", "xx")] * 3 + [(f"word{chr(97 + i)} other", "xx") for i in range(20)] + [("rare zebra", "yy"), (None, "xx"), ("no language", None)]
    model = language.fit(spark.createDataFrame(data, "text string, lang string"), sample=2)
    known = [t for t, v in data if t and v]
    held = sum((language.counts(t) > 0).astype(int) for t in known)
    assert np.allclose(model.weights, np.log((1 + len(known)) / (1 + held)) + 1)


def test_language_of_odd_rows(spark, odd):
    model = language.fit_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))
    out = language.predicted(odd, model).collect()
    assert len(out) == len(ODD)
    for r in out:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model.languages
    far = spark.createDataFrame([(1, "字" * 3000)], "doc_id long, text string")
    assert language.predicted(far, model).first()["rejected"]
    unknown = language.fit(odd.where("lang = 'none'"))
    assert language.accepted(odd, unknown).count() == 0
    kept = language.accepted(odd, model)
    assert kept.columns == odd.columns and {r["score"] for r in kept.collect()} == {7}
    assert language.predicted(odd.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_vocabulary())


def token_digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_tokens_equal_the_library(spark, rows, library):
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    got = QUERIES["op10_bpe"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == token_digests(library, texts[r["doc_id"]])


def test_tokens_of_odd_texts(spark, odd, library):
    for r in bpe.tokenised(odd, byte_vocabulary()).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == token_digests(library, r["text"])
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    assert bpe.tokenised(odd.limit(0), byte_vocabulary()).count() == 0


def test_tokens_of_random_texts(library):
    with open(byte_vocabulary(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    rng = random.Random(11)
    bag = [*"aaaabcdehlnorst   '\n\t.0127", "é", "ß", "日", " ", " ", "\u0085", "\x1c", "😀", "<|endoftext|>", "'ll", "ing"]
    texts = ["".join(rng.choice(bag) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += ["a" * 5001, "ab" * 3000, "".join(rng.choice("etaoins") for _ in range(4000)), " " * 700, "<|endoftext|>"]
    for text, packed in zip(texts, vocabulary.encode(texts), strict=True):
        assert np.frombuffer(packed, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert vocabulary.decode(packed) == text
