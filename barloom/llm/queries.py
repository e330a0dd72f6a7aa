"""The operators over the sample tables, with the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    bpe, chat, decontamination, html_text, language, licenses, merkle, negatives, repetition, sharding, simhash, topk, warc,
)
from barloom.llm.common import keep, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def byte_vocabulary() -> str:
    """Path of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs, items = table(spark, directory, "documents"), table(spark, directory, "benchmark")
    found = decontamination.contaminated(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        decontamination.items_digest(F.col("hit_items")).alias("items_sha256"), "contaminated",
    )


@query
def op2_licenses(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return licenses.licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op3_sharding(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    tree = sharding.even_tree(16)
    rows = sharding.sharded(docs, tree, sharding.grown(tree))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op4_chat(spark: SparkSession, directory: str) -> DataFrame:
    return chat.formatted(table(spark, directory, "conversations"))


ORACLE["op4_chat"] = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), whole AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS said FROM turns GROUP BY conv_id
), shorter AS (
  SELECT DISTINCT list_slice(said, 1, n) AS said
  FROM (SELECT said, unnest(range(1, len(said))) AS n FROM whole) WHERE said[n].turn < said[n + 1].turn
), kept AS (
  SELECT min(conv_id) AS conv_id, len(said) AS n_turns, count(*) AS n_copies
  FROM whole WHERE said NOT IN (SELECT said FROM shorter) GROUP BY said
), parts AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS part,
    string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
      || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
  FROM turns GROUP BY ALL
)
SELECT conv_id, part, n_turns, n_copies, length(rendered) AS n_chars, rendered FROM parts JOIN kept USING (conv_id)
"""


@query
def op5_simhash(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    rows = simhash.near_copies(docs, shingle=3, radius=3)
    hexed = F.lpad(F.lower(F.hex("bits")), 16, "0")
    return rows.select("doc_id", hexed.alias("fingerprint"), "component_id")


@query
def op6_warc(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages")
    return warc.archived(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


@query
def op7_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    out = language.predicted(docs.select("doc_id", "text"), language.fit_documents(docs))
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op8_topk(spark: SparkSession, directory: str) -> DataFrame:
    vectors = keep(topk.quantised(table(spark, directory, "embeddings")), "vectors")
    return topk.best(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLE["op8_topk"] = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS comps FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, comps) AS no FROM whole
), parts AS (
  SELECT no, vec_id, len(comps) AS width, unnest(comps) AS comp, generate_subscripts(comps, 1) AS place FROM numbered
), scored AS (
  SELECT q.no, q.vec_id AS query_id, x.no AS other, x.vec_id, CAST(sum(q.comp * x.comp) AS BIGINT) AS score
  FROM parts q JOIN parts x ON q.place = x.place AND q.width = x.width AND q.no <> x.no WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op9_html(spark: SparkSession, directory: str) -> DataFrame:
    return html_text.extracted(table(spark, directory, "pages"))


@query
def op10_bpe(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    out = bpe.tokenised(docs, byte_vocabulary(), with_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def tampered_text(key: Column, text: Column) -> Column:
    """The text without its line feeds where 2 divides the checksum of the key; null where nothing changes."""
    struck = F.crc32(key.cast("string")) % 2 == 0
    return F.when(struck & F.contains(text, F.lit("\n")), F.replace(text, F.lit("\n"), F.lit("")))


@query
def op11_merkle(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = tampered_text(F.col("doc_id"), F.col("text"))
    leaves = docs.select(
        merkle.group_name(F.col("source")).alias("group"), "doc_id",
        merkle.row_digest([*fields, F.col("text")]).alias("digest"),
        F.when(changed.isNotNull(), merkle.row_digest([*fields, changed])).alias("found"),
    )
    made = merkle.manifest(leaves, order=["doc_id"], carried=["doc_id", "found"])
    return merkle.verified(made, {"doc_id": "long", "found": "binary"}, against="found")


def _crc_table() -> list[int]:
    """One entry a byte, by the rule of the checksum's polynomial."""
    out = []
    for entry in range(256):
        for _ in range(8):
            entry = (entry >> 1) ^ (0xEDB88320 if entry & 1 else 0)
        out.append(entry)
    return out


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_ROW = " || ".join(_framed(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE["op11_merkle"] = f"""
WITH RECURSIVE crc AS (SELECT {_crc_table()} AS entries), docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS name, text, {_ROW} AS head,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: xor(a >> 8, entries[1 + (xor(a, b) & 255)])), 4294967295) AS crc
  FROM documents, crc
), hashed AS (
  SELECT doc_id, name, sha256(head || {_framed("text")}) AS leaf,
    sha256(head || {_framed("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS found
  FROM docs
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY name) AS n
  FROM hashed
), nodes AS (
  SELECT name, 0 AS level, place, leaf AS h, n FROM leaves
  UNION ALL
  SELECT name, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY name, level, place // 3, n
), subroots AS (
  SELECT name, h AS subroot, row_number() OVER (ORDER BY encode(name)) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, place, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, place // 3, n
), steps AS (
  SELECT a.name, a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM nodes a JOIN nodes b ON a.name = b.name AND a.level = b.level AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY ALL
), upper_steps AS (
  SELECT a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM upper a JOIN upper b ON a.level = b.level AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY ALL
), folds AS (
  SELECT name, place AS leaf_place, 0 AS level, place, found AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.name, leaf_place, f.level + 1, f.place // 3, sha256(before || h || after), proof || before || after
  FROM folds f JOIN steps s ON s.name = f.name AND s.level = f.level AND s.place = f.place
), folded AS (
  SELECT name, leaf_place, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM folds GROUP BY ALL
), upper_folds AS (
  SELECT f.name, leaf_place, 0 AS level, r.place, h, proof FROM folded f JOIN subroots r ON r.name = f.name
  UNION ALL
  SELECT f.name, leaf_place, f.level + 1, f.place // 3, sha256(before || h || after), proof || before || after
  FROM upper_folds f JOIN upper_steps s ON s.level = f.level AND s.place = f.place
), ends AS (
  SELECT name, leaf_place, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM upper_folds GROUP BY ALL
)
SELECT l.doc_id, l.leaf, r.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM leaves l JOIN ends e ON e.name = l.name AND e.leaf_place = l.place
JOIN subroots r ON r.name = l.name CROSS JOIN (SELECT h FROM upper WHERE n = 1) t
"""


@query
def op12_negatives(spark: SparkSession, directory: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.quantised(table(spark, directory, "embeddings"), "vec_id", "embedding", moved)
    return negatives.mined(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


ORACLE["op12_negatives"] = """
WITH whole AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS comps FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, label, comps) AS no FROM whole
), parts AS (
  SELECT no, len(comps) AS width, unnest(comps) AS comp, generate_subscripts(comps, 1) AS place FROM numbered
), scored AS (
  SELECT a.no AS a_no, x.no AS x_no, CAST(sum(a.comp * x.comp) AS BIGINT) AS score
  FROM parts a JOIN parts x ON a.place = x.place AND a.width = x.width AND a.no <> x.no
  WHERE a.no IN (SELECT no FROM numbered WHERE vec_id % 100 = 0) GROUP BY ALL
), labelled AS (
  SELECT s.*, a.vec_id AS anchor_id, x.vec_id AS other_id, a.label = x.label AS same
  FROM scored s JOIN numbered a ON a.no = a_no JOIN numbered x ON x.no = x_no
), positives AS (
  SELECT a_no, anchor_id, other_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY a_no ORDER BY score DESC, other_id) AS place
  FROM labelled WHERE same QUALIFY place <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, n.other_id AS negative_id, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.a_no, p.place ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
  FROM positives p JOIN labelled n ON n.a_no = p.a_no AND NOT n.same
    AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query
def op13_quality(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    rated = repetition.rated(
        docs, least=10, window=3, most_covered=30, most_words=50, least_words=50, most_repeated=50, with_spans=False
    )
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "base_failed", "kept"
    )


def _covered(words: int) -> str:
    """Query of (no, n): words that lie in windows of so many words that their text holds twice or more."""
    return f"""
  SELECT no, count(*) AS n FROM (
    SELECT DISTINCT no, place + unnest(range({words})) AS place FROM (
      SELECT no, place, count(*) OVER (PARTITION BY no, passage) AS times FROM (
        SELECT no, place, string_agg(word, ' ') OVER following AS passage, count(*) OVER following AS size FROM words
        WINDOW following AS (PARTITION BY no ORDER BY place ROWS BETWEEN CURRENT ROW AND {words - 1} FOLLOWING)
      ) WHERE size = {words}
    ) WHERE times > 1
  ) GROUP BY no"""


ORACLE["op13_quality"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text FROM documents
), listed AS (
  SELECT no, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS said FROM docs
), words AS (
  SELECT no, unnest(said) AS word, generate_subscripts(said, 1) AS place FROM listed
), triples AS ({_covered(3)}
), passages AS ({_covered(10)}
), too_long AS ({_covered(51)}
), counted AS (
  SELECT no, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM words GROUP BY no
), lines AS (
  SELECT no, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT no, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY no
), measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(t.n, 0) AS n_repeat_words, coalesce(p.n, 0) AS n_covered_words, coalesce(x.n, 0) = 0 AS short_enough
  FROM docs LEFT JOIN counted USING (no) LEFT JOIN lines USING (no) LEFT JOIN triples t USING (no)
  LEFT JOIN passages p USING (no) LEFT JOIN too_long x USING (no)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT * EXCLUDE (short_enough), NOT base_failed AND 100 * n_covered_words <= 30 * n_words AND short_enough AS kept FROM judged
"""
