"""The Merkle manifest, hard negatives and repetition, against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import merkle, negatives, repetition
from tests.llm.conftest import ODD


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """Root, and for each node what stands before and after it, level by level."""
    proofs, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for k in range(len(run)):
                for owner in owners[i + k]:
                    proofs[owner].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(h("".join(run)))
            over.append(sum(owners[i:i + 3], []))
        nodes, owners = above, over
    return nodes[0], proofs


def expected(rows):
    """(id, group, leaf, now) to the sorted rows of ``verified``."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    made = {n: tree([r[2] for r in groups[n]]) for n in names}
    root, above = tree([made[n][0] for n in names])
    out = []
    for name, upper in zip(names, above, strict=True):
        subroot, proofs = made[name]
        for row, proof in zip(groups[name], proofs, strict=True):
            node = row[3] or row[2]
            for before, after in proof + upper:
                node = h(before + node + after)
            siblings = "".join(b + a for b, a in proof + upper)
            out.append((row[0], row[2], subroot, root, h(siblings), node, node == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows):
    """Operator's rows for (id, group, leaf hex, changed leaf hex or None)."""
    leaves = spark.createDataFrame(rows, "id long, source string, leaf string, now string").select(
        merkle.group_name(F.col("source")).alias("group"), "id", F.unhex("leaf").alias("digest"), F.unhex("now").alias("now")
    )
    made = merkle.manifest(leaves, ["id"], ["id", "now"])
    return sorted(map(tuple, merkle.verified(made, {"id": "long", "now": "binary"}, "now").collect()), key=repr)


def test_layout_places_every_node_once_with_halves_together():
    for levels in range(1, 8):
        at = merkle.layout(levels)
        places = np.concatenate(at)
        assert sorted(places) == list(range((3**levels - 1) // 2))
        assert [len(d) for d in at] == [3**d for d in range(levels)]
    # Seven levels: the upper three come first, and each subtree of four levels is one range.
    at = merkle.layout(7)
    assert max(np.concatenate(at[:3])) == 12
    for number in range(27):
        inside = np.concatenate([at[3 + d][number * 3**d:(number + 1) * 3**d] for d in range(4)])
        assert sorted(inside) == list(range(13 + 40 * number, 13 + 40 * (number + 1)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 729])
def test_block_equals_tree(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = merkle.levels_over(n)
    block = merkle.Block(merkle.built_block(bytes.fromhex("".join(leaves)), levels), n, levels)
    root, proofs = tree(leaves)
    assert block.digests(0)[0].hex() == root
    assert [[(b.hex(), a.hex()) for b, a in p] for p in block.proofs()] == proofs


def test_manifest_of_several_tiers_equals_brute_force(spark):
    """A group of four blocks, one of exactly a block, one leaf alone, null and odd names, changed leaves."""
    random.seed(3)
    sizes = {"hot": 2_300, "whole": 729, "over": 730, None: 5, "": 1, "é": 2, "z": 3}
    rows = []
    for name, size in sizes.items():
        for i in range(size):
            rows.append((i if i % 50 else i + 1, name, h(f"{name}{i}"), h(f"changed{i}") if i % 97 == 3 else None))
    random.shuffle(rows)
    found = manifest_rows(spark, rows)
    assert found == expected(rows)
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_many_groups(spark):
    """More groups than a block has leaves, so the tree above has two tiers too."""
    rows = [(i, f"g{i % 800:03}", h(str(i)), None) for i in range(1_600)]
    assert manifest_rows(spark, rows) == expected(rows)


def test_manifest_of_odd_rows(spark):
    """Null ids come first, equal rows are leaves of their own, one row has no siblings, none give none."""
    rows = [(None, "a", h("1"), None), (None, "a", h("1"), None), (4, "a", h("2"), h("2")), (4, "a", h("0"), h("9"))]
    assert manifest_rows(spark, rows) == expected(rows)
    [alone] = manifest_rows(spark, [(1, None, h("x"), None)])
    assert alone == (1, h("x"), h("x"), h("x"), h(""), h("x"), True)
    assert manifest_rows(spark, []) == []


def test_row_digest_frames_fields(spark):
    rows = [(1, "é", None), (None, "", "long " * 50_000), (2, "1:2", "-")]
    df = spark.createDataFrame(rows, "a long, b string, c string")
    found = [r[0] for r in df.select(F.lower(F.hex(merkle.row_digest([F.col(c) for c in "abc"])))).collect()]
    frame = [["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r] for r in rows]
    assert found == [h("".join(f)) for f in frame]


def brute_negatives(rows, positives=5, count=10, low=30, high=90):
    """(vec_id, label, comps) to the operator's rows."""
    rows = sorted(set(rows))
    out = []
    for anchor in rows:
        if anchor[0] % 100:
            continue
        others = [r for r in rows if r != anchor and len(r[2]) == len(anchor[2])]
        scored = [(max(min(sum(a * b for a, b in zip(anchor[2], r[2], strict=True)), negatives.TOP), -negatives.TOP), r) for r in others]
        scored.sort(key=lambda s: (-s[0], s[1][0]))
        for ps, positive in [s for s in scored if s[1][1] == anchor[1]][:positives]:
            fit = [s for s in scored if s[1][1] != anchor[1] and low * ps <= 100 * s[0] <= high * ps][:count]
            out += [(anchor[0], positive[0], i, r[0], ps, score) for i, (score, r) in enumerate(fit, 1)]
    return sorted(out)


def mined_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label long, comps array<long>")
    return sorted(map(tuple, negatives.mined(df.distinct(), F.col("vec_id") % 100 == 0).collect()))


def test_negatives_equal_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "VECTOR_BLOCK", 128)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 4)
    random.seed(5)
    rows = [(i, random.choice([0, 0, 0, 1, 2, 3]), tuple(random.randint(-9, 12) for _ in range(6))) for i in range(1_500)]
    found = mined_rows(spark, rows)
    assert found == brute_negatives(rows) and len(found) > 500


def test_negatives_of_odd_rows(spark):
    """Ties, repeated rows, ids shared by different rows, several lengths, labels of one row, huge components."""
    random.seed(6)
    rows = [(i % 40 * 50, i % 3, tuple(random.randint(0, 2) for _ in range(2 + i % 2))) for i in range(300)]
    rows += rows[:50] + [(100, 7, (1, 1)), (300, 1, (1 << 62, 5, 5)), (400, 2, (1 << 61, 1, 0)), (500, 1, (-(1 << 62), 3, 0))]
    assert mined_rows(spark, rows) == brute_negatives(rows)
    assert mined_rows(spark, []) == []
    assert mined_rows(spark, rows[1:2]) == []


@pytest.mark.parametrize("size", [1, 200, 1 << 14, 1 << 40, negatives.TOP])
def test_residue_products_are_exact(size):
    rng = np.random.default_rng(size % 1000)
    a, b = (rng.integers(-size, size, (n, 150), endpoint=True, dtype=np.int64) for n in (7, 11))
    bound = 150 * size * size
    exact = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert math.prod(negatives.primes_for(bound)) > 2 * bound
    assert negatives.scores(a, b, bound).tolist() == [[max(min(v, negatives.TOP), -negatives.TOP) for v in r] for r in exact]


def test_quantised_takes_whole_vectors_once(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, [0.5, -0.001]), (1, 1, [0.5, -0.001]), (1, 2, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [1.0, None]),
        (5, 1, [nan]), (6, 1, [inf]), (7, 1, []), (None, 1, [1.0]), (8, 1, [1e300]), (9, 1, [-1e300]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, comps string")
    found = sorted(map(tuple, negatives.quantised(df, "vec_id", "embedding", F.col("label")).collect()))
    top = negatives.TOP
    assert found == [(1, 1, [128, -1]), (1, 2, [128, -1]), (8, 1, [top]), (9, 1, [-top])]


def brute_repetition(raw, least, window):
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    n = len(words)

    def places(m):
        found = {}
        for i in range(n - m + 1):
            found.setdefault(tuple(words[i:i + m]), []).append(i)
        return [v for v in found.values() if len(v) > 1]

    def covered(m):
        return len({i + k for v in places(m) for i in v for k in range(m)})

    longest = max((m for m in range(1, n) if places(m)), default=0)
    maximal = 0
    for m in range(least, longest + 1):
        for starts in places(m):
            before = {words[i - 1] if i else None for i in starts}
            after = {words[i + m] if i + m < n else None for i in starts}
            maximal += len(before) > 1 and len(after) > 1
    chars = len(b"".join(words).decode())
    lines = [x for x in raw.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(rb"[#*$%&|<>]", raw))
    return n, chars, symbols, len(lines) - len(set(lines)), covered(window), covered(least), longest, maximal


@pytest.mark.parametrize("least", [1, 2, 4])
@pytest.mark.parametrize("group", [1, 40, 1 << 18])
def test_repetition_equals_brute_force(monkeypatch, least, group):
    monkeypatch.setattr(repetition, "GROUP", group)
    random.seed(least)
    alphabets = ["a", "ab", "a é #", ["x", "y\n", "\n", "z\t", "w|"], [f"w{i}" for i in range(40)]]
    texts = [
        " ".join(random.choice(letters) for _ in range(random.randint(0, 50))).encode()
        for letters in alphabets for _ in range(40)
    ]
    found = list(repetition.measured(texts, least, 3, True))
    for text, row in zip(texts, found, strict=True):
        assert row[:8] == brute_repetition(text, least, 3), text
        assert sum(end - start for start, end in row[8]) == row[5]


def test_rated_decides_by_words_and_passages(spark):
    """The base rules, a long passage said twice, and a text that is fine."""
    fresh = [f"w{i}" for i in range(400)]
    passage = " ".join(fresh[:51])
    texts = {
        1: None, 2: "", 3: " \n\t ", 4: "few words", 5: "word " * 30_000, 6: " ".join(fresh),
        7: " ".join([*fresh, passage]), 8: " ".join([*fresh, *fresh[:50]]), 9: " ".join(f"{a} {a}" for a in fresh),
        10: " ".join([*fresh[:140], *fresh[:20], "x", *fresh[20:40]]), 11: " ".join([*fresh[:100], *fresh[:15], "x", *fresh[15:30]]),
        12: " ".join(fresh), 13: " ".join(fresh) + "\nsame line\nsame line\n\n\n",
    }
    rows = [(k, t, "mine", 5) for k, t in [*texts.items(), (6, texts[6])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, _llm_words string, score int")
    found = {r.doc_id: r for r in repetition.rated(df, window=3).collect()}
    assert {k for k, r in found.items() if r.base_failed} == {1, 2, 3, 4, 5, 12}
    assert {k for k, r in found.items() if r.kept} == {6, 8, 9, 13}
    assert found[5].spans == [[0, 30_000]] and found[5].longest_repeat == 29_999
    assert found[7].longest_repeat == 51 and found[7].spans == [[0, 51], [400, 451]]
    assert (found[13].n_dup_lines, found[12].n_words, found[1].n_words) == (1, 1, 0)
    assert all(r._llm_words == "mine" and r.score == 5 for r in found.values())


def test_rated_odd_and_empty_tables(spark, odd):
    found = repetition.rated(odd).collect()
    assert len(found) == len(ODD)
    for row in found:
        raw = (row.text or "").encode()
        if len(raw) < 10_000:
            assert tuple(row[c] for c in list(repetition.FIELDS)[:8]) == brute_repetition(raw, 10, 3)
    assert repetition.rated(odd.limit(0)).collect() == []
