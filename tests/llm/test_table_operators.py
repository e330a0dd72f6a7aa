"""SimHash groups, shards, conversations, archives, top-k and page texts against brute force and on odd rows."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash

import corpus_pipeline
from barloom.llm import bpe, chat, components, decontamination, html_text, language, sharding, simhash, topk, warc
from barloom.llm.queries import ORACLE, QUERIES, byte_vocabulary
from barloom.session import scratch_path

from .conftest import ODD, SMALL


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def grouped(nodes, pairs):
    parent = {n: n for n in nodes}
    for a, b in pairs:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {n: find(parent, n) for n in nodes}


def print_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    w = [x for x in lowered.split(" ") if x]
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def near(values, radius):
    values = sorted(values)
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= radius]


def test_simhash_equals_brute_force(spark, rows):
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    prints = {k: print_of(t) for k, t in texts.items()}
    of_print = grouped(set(prints.values()), near(set(prints.values()), 3))
    least = {}
    for k, p in prints.items():
        least[of_print[p]] = min(k, least.get(of_print[p], k))
    got = QUERIES["op5_simhash"](spark, SMALL).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {
        (k, f"{p:016x}", least[of_print[p]]) for k, p in prints.items()
    }
    assert len(set(of_print.values())) < len(texts)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_simhash_links_random_neighbours(spark, radius):
    rng = random.Random(radius)
    values = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            values.add(value)
            for bit in rng.sample(range(64), rng.randint(0, radius + 1)):
                value ^= 1 << bit
    prints = spark.createDataFrame([(simhash.signed(v),) for v in values], "bits long")
    roots = {r["bits"] % (1 << 64): r["root"] for r in simhash.linked_prints(prints, radius).collect()}
    want = grouped(values, near(values, radius))
    sizes = Counter(want.values())
    assert set(roots) == {v for v in values if sizes[want[v]] > 1}
    assert len({(roots[v], want[v]) for v in roots}) == len({roots[v] for v in roots}) == len({want[v] for v in roots})


def test_components_of_a_long_chain_and_a_star(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    pairs = [*zip(order, order[1:], strict=False), *((1000, 1001 + i) for i in range(200)), (5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert set(got) == {*range(300), *range(1000, 1201)}
    assert len({got[n] for n in range(300)}) == 1 and len({got[n] for n in range(1000, 1201)}) == 1
    assert got[0] != got[1000]


def test_simhash_of_odd_rows(spark, odd):
    out = simhash.near_copies(odd).collect()
    assert len(out) == len(ODD)
    empty = {r["component_id"] for r in out if r["bits"] == 0}
    assert empty == {1}
    # The copies of 8 and the row of 9 are one group; ids that repeat don't join other texts.
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    left = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert left[(8, "same text in two rows")] == 1 and (9, "same text in two rows") not in left
    assert left[(1, None)] == 1 and (2, "") not in left and (3, "   \n\t ") not in left
    assert left[(None, "a row without an id")] == 1 and left[(11, "another text")] == 1
    assert simhash.near_copies(odd.limit(0)).count() == 0 and simhash.one_of_each(odd.limit(0)).count() == 0
    alone = odd.where("doc_id is null and text is null")
    assert simhash.one_of_each(alone.unionByName(alone)).count() == 1


def draw(key, level, child, weight):
    bits = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    for part in (level, child):
        bits = xxhash.xxh64_intdigest(struct.pack("<q", part), bits)
    return -math.log(((bits >> 11) + 1) / 2.0**53) / weight


def mass(node):
    return sum(map(mass, node.values())) if isinstance(node, dict) else node


def path(key, tree):
    """Region, rack and shard of a key, one level after the other."""
    out, node = [], tree
    while isinstance(node, dict):
        child = min((c for c in node if mass(node[c])), key=lambda c: (draw(key, len(out), c, mass(node[c])), c))
        out.append(child)
        node = node[child]
    return out


def test_shards_equal_brute_force(spark, rows):
    texts = {r["doc_id"]: r["text"] for r in rows("documents")}
    got = QUERIES["op3_sharding"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["shard"] == path(r["doc_id"], sharding.even_tree(16))[-1]
        assert r["grown_shard"] == path(r["doc_id"], sharding.grown(sharding.even_tree(16)))[-1]
        assert r["grown_shard"] in (r["shard"], 16)
    check_slots(got)


def check_slots(got):
    for shard in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))


def moved(spark, tree, later, n=6000):
    """(path before, path after) of the keys that move, and the count of keys in each shard before and after."""
    keys = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("_node", chat.F.lit("kept"))
    out = sharding.descended(sharding.descended(keys, tree, "doc_id", "a"), later, "doc_id", "b").collect()
    paths = [(path(r["doc_id"], tree), path(r["doc_id"], later)) for r in out]
    assert [(a[-1], b[-1]) for a, b in paths] == [(r["a"], r["b"]) for r in out]
    assert {r["_node"] for r in out} == {"kept"}
    return [(a, b) for a, b in paths if a != b], Counter(r["a"] for r in out), Counter(r["b"] for r in out)


TREE = {0: {0: {0: 1.0, 1: 3.0}}, 1: {1: {2: 2.0, 4: 1.0}, 2: {3: 2.0}}}


def test_shards_hold_rows_by_weight(spark):
    moves, before, after = moved(spark, TREE, TREE)
    assert not moves
    for shard, weight in {0: 1, 1: 3, 2: 2, 3: 2, 4: 1}.items():
        assert abs(before[shard] - 6000 * weight / 9) < 250


def test_a_shard_that_gains_weight_moves_rows_on_its_own_path_only(spark):
    heavier = {0: TREE[0], 1: {1: {2: 4.0, 4: 1.0}, 2: {3: 2.0}}}
    moves, before, after = moved(spark, TREE, heavier)
    # Level by level: into region 1, or within it into rack 1, or within that into shard 2.
    assert {(a[0], b[0]) for a, b in moves} == {(0, 1), (1, 1)}
    assert {(a[1], b[1]) for a, b in moves if a[0] == b[0]} == {(2, 1), (1, 1)}
    assert {(a[2], b[2]) for a, b in moves if a[:2] == b[:2]} == {(4, 2)}
    assert all(abs(after[s] - 6000 * w / 11) < 250 for s, w in {0: 1, 1: 3, 2: 4, 3: 2, 4: 1}.items())


def test_a_shard_that_loses_weight_gives_rows_away(spark):
    lighter = {0: TREE[0], 1: {1: {2: 0.0, 4: 1.0}, 2: {3: 2.0}}}
    moves, _, after = moved(spark, TREE, lighter)
    assert {a[0] for a, _ in moves} == {1} and 2 not in after
    assert {b[0] for a, b in moves if a[1] == 2} <= {0}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_a_shard_more_takes_rows_only_into_itself(spark, shards):
    tree = sharding.even_tree(shards)
    moves, _, after = moved(spark, tree, sharding.grown(tree))
    assert {b[-1] for _, b in moves} == {shards}
    assert len(moves) == after[shards] and abs(after[shards] - 6000 / (shards + 1)) < 250


def test_shards_of_odd_rows(spark, odd):
    out = sharding.sharded(odd, sharding.even_tree(16), sharding.grown(sharding.even_tree(16))).collect()
    assert len(out) == len(ODD)
    check_slots(out)
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert sharding.sharded(odd.limit(0), sharding.even_tree(3), sharding.even_tree(4)).count() == 0
    many = spark.createDataFrame([(4, "x")] * 5000, "doc_id long, text string")
    check_slots(sharding.sharded(many, sharding.even_tree(4), sharding.even_tree(5)).collect())


def duck(**tables):
    connection = duckdb.connect()
    for name, (columns, data) in tables.items():
        connection.execute(f"CREATE TABLE {name} ({columns})")
        if data:
            connection.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(data[0]))})", data)
    return connection


def same_rows(df, answer):
    names = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert got == sorted(answer.fetchall(), key=repr)
    return got


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("conversations", "embeddings", "documents"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert same_rows(QUERIES[name](spark, SMALL), connection.execute(ORACLE[name]))


def test_conversations_that_grew(spark):
    said = [("user", "hi"), ("assistant", "hello"), ("user", "more?"), ("assistant", "yes <|im_end|>")]
    data = [(c, t, *said[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in range(n)]
    data += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, 0, "user", None), (6, 1, None, ""), (7, 1, "user", "late")]
    data += [(8, t, "user", f"turn {t}") for t in range(600)] + [(9, t, "user", f"turn {t}") for t in range(300)]
    data += [(12, 0, "user", None), (13, 0, "user", "\0"), (13, 1, "user", "x"), (14, 0, "user", ""), (14, 1, "user", "y")]
    data += [(2, 0, "user", "hi"), (10, 0, "user", "hi"), (10, 0, "user", "again"), (None, 0, "user", "lost"), (11, None, "user", "lost")]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("n_turns", chat.F.lit(0))
    got = same_rows(chat.formatted(df), duck(conversations=("conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", data)).execute(ORACLE["op4_chat"]))
    # A null text is neither "" nor any other text, and 600 turns are one row unless parts are asked for.
    assert {r[0] for r in got} == {2, 5, 6, 7, 8, 10, 13, 14} and len(got) == 8
    parts = chat.formatted(df, by_part=True).where("conv_id = 8").orderBy("part").collect()
    assert [r["part"] for r in parts] == [0, 1, 2]
    assert "".join(r["rendered"] for r in parts) == chat.formatted(df).where("conv_id = 8").first()["rendered"]
    assert chat.formatted(df.limit(0)).count() == 0


def revisit_truth(pages):
    last = {}
    for page, _, text in pages:
        raw = (text or "").encode()
        last[raw] = page if last.get(raw) is None else last[raw] if page is None else max(page, last[raw])
    out = Counter()
    for page, _, text in pages:
        raw = (text or "").encode()
        refers = None if page == last[raw] else last[raw]
        kind = "response" if refers is None else "revisit"
        out[page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, refers] += 1
    return out


def archive_rows(df):
    got = df.collect()
    assert all(r["verified"] for r in got)
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)


def test_archives_round_trip(spark, rows):
    pages = [(r["page_id"], r["url"], r["html"]) for r in rows("pages")]
    assert archive_rows(QUERIES["op6_warc"](spark, SMALL)) == revisit_truth(pages)


def test_archives_of_odd_pages(spark):
    pages = [(1, "http://a/ü\r\nX: y", "same"), (2, None, "same"), (3, "http://b", None), (4, "", ""), (None, "http://c", "same")]
    pages += [(None, "http://d", "alone"), (5, "http://e", "line\r\n\r\nWARC/1.1\r\n\r\n" * 9), (5, "http://e", "line\r\n\r\nWARC/1.1\r\n\r\n" * 9)]
    pages += [(6, "http://f", "".join(map(chr, range(1, 3000))) * 400), (2**53 + 1, "http://g", "big number")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert archive_rows(warc.archived(df)) == revisit_truth(pages)
    assert warc.archived(df.limit(0)).count() == 0


def test_archives_roll_and_hold_one_member_per_record(spark, tmp_path):
    data = [(i, f"http://a/{i}", f"page {i} " * 50) for i in range(40)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(df.withColumn("refers_to", chat.F.lit(None).cast("long")), str(tmp_path), size=2000)
    found = archives.collect()
    assert len(found) > 3 and sum(r["records"] for r in found) == 40
    with open(found[0]["path"], "rb") as file:
        raw, members = file.read(), 0
    assert len(raw) == found[0]["bytes"]
    while raw:
        inflate = zlib.decompressobj(31)
        text = inflate.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and inflate.eof
        raw, members = inflate.unused_data, members + 1
    assert members == found[0]["records"]
    assert warc.read_archives(archives).count() == 40


@pytest.mark.parametrize("harm", ["cut", "payload"])
def test_broken_archives_are_noticed(spark, harm):
    folder = scratch_path(spark, "warc")
    folder = folder if "://" in folder else f"/{folder.lstrip('/')}"
    df = spark.createDataFrame([(1, "http://a", "some text " * 300, None)], "page_id long, url string, html string, refers_to long")
    archives = warc.write_archives(df, folder)
    path = archives.first()["path"]
    with open(path, "rb") as file:
        raw = file.read()
    if harm == "cut":
        raw = raw[: len(raw) // 2]
    else:
        member = zlib.compressobj(6, zlib.DEFLATED, 31)
        raw = member.compress(zlib.decompress(raw, 31).replace(b"some text some", b"same text some", 1)) + member.flush()
    with open(path, "wb") as file:
        file.write(raw)
    if harm == "cut":
        with pytest.raises(Exception, match="within a record"):
            warc.read_archives(archives).collect()
    else:
        assert [r["verified"] for r in warc.read_archives(archives).collect()] == [False]


def best_truth(vectors, k=5):
    out = []
    for q, a in vectors.items():
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), v) for v, b in vectors.items() if v != q and len(a) == len(b))
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(4096, 256), (7, 3)])
def test_best_vectors_with_ties_and_odd_rows(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", sizes[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[1])
    rng = random.Random(9)
    data = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(120)]
    data += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 230)] + [(300, [0.5, 2.5]), (301, [1e3, -7.0]), (350, [3.0])]
    odd = [(400, None), (401, [1.0, None, 1.0, 1.0]), (402, [float("nan")] * 4), (450, [float("inf")] * 4), (None, [9.0] * 4), (403, []), data[0]]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>")
    vectors = topk.quantised(df)
    got = topk.best(vectors, vectors.where("vec_id % 50 = 0"), 5).collect()
    whole = {k: [math.floor(256 * x) for x in v] for k, v in data}
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == best_truth(whole)
    assert topk.best(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_best_vectors_of_large_numbers(spark):
    data = [(i, [float(i * 2**16 + 1), float(-i * 2**15)]) for i in range(0, 60)]
    df = topk.quantised(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = topk.best(df, df.where("vec_id % 50 = 0"), 5).collect()
    whole = {k: [math.floor(256 * x) for x in v] for k, v in data}
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == best_truth(whole)


def test_best_vectors_of_repeated_ids_and_huge_components(spark):
    """Rows of one id that differ are rows of their own, equal ones count once, and scores are cut at 64 bits."""
    data = [(7, [5.0, 0.0]), (7, [9.0, 0.0]), (7, [9.0, 0.0]), (50, [1.0, 0.0]), (50, [2.0, 0.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = topk.best(topk.quantised(df), topk.quantised(df).where("vec_id % 50 = 0"), 5)
    schema = ("vec_id BIGINT, embedding FLOAT[]", data)
    got = same_rows(found, duck(embeddings=schema).execute(ORACLE["op8_topk"]))
    assert len(got) == 8 and sum(r[2] == 7 for r in got) == 4 and sum(r[2] == 50 for r in got) == 2
    huge = topk.quantised(spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>"))
    found = topk.best(huge, huge.where("vec_id = 0"), 5).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 1, topk.TOP), (2, 2, -topk.TOP)]


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 25))] for _ in range(2))
        places = html_text.shared(a, b)
        assert places == sorted(set(places)) and len(places) == longest(a, b)
        rest = iter(b)
        assert all(a[p] in rest for p in places)


def test_page_texts_equal_their_documents(spark, rows):
    docs = {" ".join((r["text"] or "").split()) for r in rows("documents")}
    got = QUERIES["op9_html"](spark, SMALL).collect()
    assert len(got) == len(rows("pages"))
    # A page is a document under a heading.
    right = sum(" ".join(" ".join(r["text"].split("\n")[1:]).split()) in docs for r in got)
    assert right >= 0.98 * len(got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


MENU = "<nav><ul><li>Home<li>About</ul></nav>"


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    (f"<html><head><title>T</title></head><body>{MENU}<article><h1>A</h1><p>b<br>c  d\n e<p>f</article><footer>g</footer>", "A\nb c d e\nf"),
    ("<article><p>x</p><script>var t='</p>';</script><style>p{}</style><!-- no <p>y</p> --><p>z &lt;b&gt;</p></article>", "x\nz <b>"),
    ("<main><p>a</p><div class='ad box'><div>b</div>c</div><p>d</p><section id=comments><p>e</p></section></main>", "a\nd"),
    ("<article><p>a <b>bold</b> <i>word</i></p><form><input><p>b</p></form><aside>c</aside><p>d", "a bold word\nd"),
    ("<nav><ul><li>never closed<article><p>a</p></article>", "a"),
    ("<article><p>1 < 2 and <3</p><p class=", "1 < 2 and <3"),
    ("<body class='has-sidebar modal'><main class='content ad-free'><p>a</p><p class='no-ads'>b</p></main><p>c</p>", "a\nb"),
    ("<article class='post comment-count-2'><p data-role=notice>a</p><article class=comment-body>b</article><p>c</p></article>"
     "<article class=comment>d</article>", "a\nc"),
    ("<article><p>a<p class=ad>b<p>c<li class=ad>d</li><p class=promo>e</article><p>f", "a\nc"),
    ("<div class='cookie-notice'>x</div><div class=header-menu>y</div><p>t&eacute;xt&nbsp;z</p>", "téxt z"),
])
def test_markup(spark, page, text):
    df = spark.createDataFrame([(1, "http://h/p", page)], "page_id long, url string, html string")
    assert [tuple(r) for r in html_text.extracted(df).collect()] == [(1, "http://h/p", text, len(text))]


def test_pages_without_marked_article_are_differenced(spark):
    page = lambda n: f"<div>Our site</div><p>story {n}</p><p>more {n}</p><div>All rights</div>"
    data = [(i, f"http://h{i % 2}/news/{i:03d}?q={i}", page(i)) for i in range(40)]
    data += [(100, "http://h0/news/000", page(0)), (101, None, page(7)), (102, "http://alone/x", "<p>only one</p>")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in html_text.extracted(df).collect()}
    for i in range(40):
        assert got[i] == f"story {i}\nmore {i}"
    assert got[100] == "story 0\nmore 0"
    assert got[101] == "Our site\nstory 7\nmore 7\nAll rights" and got[102] == "only one"
    assert html_text.extracted(df.limit(0)).count() == 0


def test_pipeline_equals_brute_force(spark, rows):
    docs = rows("documents")
    model = language.fit_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rejected = [r for _, _, r in model.predict([d["text"] for d in docs])]
    docs = [d for d, r in zip(docs, rejected, strict=True) if not r]
    prints = {d["doc_id"]: print_of(d["text"]) for d in docs}
    roots = grouped(set(prints.values()), near(set(prints.values()), 3))
    least = {}
    for k, p in prints.items():
        least[roots[p]] = min(k, least.get(roots[p], k))
    docs = [d for d in docs if d["doc_id"] in least.values()]
    index = decontamination.Index([(str(r["item_id"]), r["text"]) for r in rows("benchmark")], 10)
    docs = [d for d in docs if not index.scan(d["text"])[1]]
    with open(byte_vocabulary(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    want = {d["doc_id"]: hashlib.sha256(p).hexdigest() for d, p in zip(docs, vocabulary.encode([d["text"] for d in docs]), strict=True)}
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"]: r["ids_sha256"] for r in got.collect()} == want
    assert 0 < len(want) < len(rows("documents"))


def test_pipeline_stages_on_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", odd["score"].cast("long").alias("n_chars"))
    for given in (docs, docs.limit(0)):
        out = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SMALL)
            assert out.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, SMALL).count() == out.count()


def site_truth(pages):
    """Texts of unmarked pages, from whole lists: runs of near copies in order of path, nearest page beyond them."""
    def alike(a, b):
        shared = sum(len(v) for v in a if v in b)
        return all(shared >= html_text.NEAR * sum(map(len, x)) for x in (a, b))

    def agree(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    found = {}
    for host in {h for h, _, _ in pages}:
        first = {}
        for _, url_path, lines in sorted(p for p in pages if p[0] == host):
            first.setdefault(tuple(lines), url_path)
        line_up = sorted((url_path, lines) for lines, url_path in first.items())
        run = [0]
        for (_, a), (_, b) in zip(line_up, line_up[1:], strict=False):
            run.append(run[-1] + (not alike(a, b)))
        for i, (url_path, lines) in enumerate(line_up):
            before = [j for j in range(i) if run[j] != run[i]][-1:]
            after = [j for j in range(i, len(run)) if run[j] != run[i]][:1]
            near = sorted(before + after, key=lambda j: (-agree(url_path, line_up[j][0]), j))
            other = line_up[near[0]][1] if near else ()
            found[host, lines] = "\n".join(v for v in lines if v not in other)
    return found


def test_near_copies_are_no_measure_of_what_a_site_repeats(spark):
    story = [f"a sentence of the story number {i}, longer than a menu" for i in range(8)]
    data = [("h", f"/a?page={i}", ["Home", "About", *story, f"date {i}"]) for i in (1, 2)]
    data += [("h", "/b", ["Home", "About", "quite another story here", "date 3"]), ("alone", "/a", [*story, "x"]), ("alone", "/b", [*story, "y"])]
    df = spark.createDataFrame(
        [(i, f"http://{h}{p}", "".join(f"<p>{v}</p>" for v in lines)) for i, (h, p, lines) in enumerate(data)],
        "page_id long, url string, html string",
    )
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.extracted(df).collect()}
    assert got[0] == [*story, "date 1"] and got[1] == [*story, "date 2"]
    assert got[2] == ["quite another story here", "date 3"]
    assert got[3] == [*story, "x"] and got[4] == [*story, "y"]


def test_pages_with_marked_article_are_differenced(spark):
    """Blocks that names put in doubt go if the site repeats them; the article's own running text stays."""
    def page(n):
        return (f'<div>Site {n}</div><article><p>story {n}</p><p>A quotation both stories have.</p><p>end {n}</p>'
                f'<div class="related-stories"><p>More to read</p><div>of story {n}</div><p>Our best</p></div>'
                f'<p class="share-price">Price today</p><p>told on day {n}</p></article><div>All rights</div>')

    data = [(i, f"http://h/{i}", page(i)) for i in range(3)] + [(3, "http://alone/x", page(0))]
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.extracted(
        spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == [f"story {i}", "A quotation both stories have.", f"end {i}", f"of story {i}", f"told on day {i}"]
    assert got[3] == ["story 0", "A quotation both stories have.", "end 0", "More to read", "of story 0", "Our best", "Price today", "told on day 0"]


def test_unmarked_sites_equal_brute_force(spark):
    draw = random.Random(6)
    data = []
    for host in ("big", "small", "one"):
        menu = [f"{host} menu {i}" for i in range(6)]
        for n in range({"big": 150, "small": 12, "one": 1}[host]):
            story = [f"{host} story {n} says this in line {i}" for i in range(draw.randint(1, 9))]
            # A run of copies that differ in one short line; some runs are longer than a task's part.
            for copy in range(40 if n == 70 else draw.choice([1, 1, 1, 2, 3])):
                # Equal lines stand in one order on all pages, so there is one longest common subsequence.
                top, bottom = ([m for m in part if draw.random() < 0.8] for part in (menu[:3], menu[3:]))
                data.append((host, f"/{n // 10}/{n:03d}/{copy:02d}", [*top, *story, f"c{n}.{copy}", *bottom]))
    data += [draw.choice(data) for _ in range(20)]
    df = spark.createDataFrame(
        [(i, f"http://{h}{p}", "".join(f"<div>{v}</div>" for v in lines)) for i, (h, p, lines) in enumerate(data)],
        "page_id long, url string, html string",
    )
    truth = site_truth(data)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # several parts, so runs reach over their edges
    try:
        got = {r["page_id"]: r["text"] for r in html_text.extracted(df.repartition(7)).collect()}
    finally:
        spark.conf.set(setting, before)
    assert got == {i: truth[h, tuple(lines)] for i, (h, _, lines) in enumerate(data)}


@pytest.mark.parametrize(("page", "text"), [
    ('<article><p class="share-price">a</p><p id="notice-of-motion">b</p><p>c <em class="notice">d</em></article>', "a\nb\nc d"),
    ('<article>a<div class="ad">x</div><div class="share-buttons">y</div><ul class="comment-list"><li>z</ul><p class="ad">w</p>b</article>', "a\nb"),
    ('<div class="widget"><p>only text</p></div>', "only text"),
    ('<div id="comments-off"><article><p>a</article></div>', "a"),
    ('<div class="widget-page"><nav>m</nav><article>a</article></div>', "a"),
    ('<div class="comments"><article>reader</article></div><article>writer</article>', "writer"),
])
def test_names_of_elements(page, text):
    lines, inside = html_text.lines_of(page)
    assert "\n".join(v for v, within in zip(lines, inside, strict=True) if within or not any(inside)) == text
