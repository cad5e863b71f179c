"""The operators as queries on the given tables, and the SQL that must return the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietwire.llm import chat, digest_index, manifest, mixing, neighbours, ngram_join, packing, phrases, quality, sharding, substring_dedup, topk, toxicity
from quietwire.llm.common import read
from quietwire.session import shared_folder


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, lexicon).withColumn("held_out", toxicity.held_out())
    return scored.select("doc_id", "held_out", "score", "predicted", "total", "hits", "words")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    counted_on = rows.where((F.crc32(F.col("conv_id").cast("string")) % 5) != 0)
    model, texts = chat.learn(counted_on), rows.select("conv_id", "turn", "text")
    given = chat.format_turns(texts, model).drop("text").withColumn("form", F.lit("turns"))
    joined = chat.format_joined(texts, chat.learn_lines(counted_on), model).drop("text").withColumn("form", F.lit("transcript"))
    return given.unionByName(joined)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, rows.where(F.col("vec_id") % 100 == 0))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join(read(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select("doc_id", "words", "removed_words", "removed", "text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer())


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(rows, rows.where(F.col("vec_id") % 50 == 0))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    fitted_on = ~toxicity.held_out()
    model = quality.learn(docs, labels.where(fitted_on & (F.col("quality") == 1)), docs.where(fitted_on))
    scored = quality.score(docs, model).withColumn("held_out", toxicity.held_out())
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a new index, the larger ids first, so that the second meets what the first has left."""
    rows = digest_index.digests(read(spark, sf_dir, "documents"))
    folder = f"{shared_folder(spark).rstrip('/')}/quietwire/{spark.sparkContext.applicationId}"
    index = digest_index.DigestIndex(spark, f"{folder}/digest-index-{uuid.uuid4().hex}")
    for number, part in enumerate(digest_index.largest_first(rows, 2)):
        index.load(part, f"load {number}")
    decided = index.decide(rows).withColumn("text_sha256", F.lower(F.hex("digest")))
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = manifest.leaves(docs, tampered, manifest.lower_ascii(F.col("text")))
    return manifest.prove(manifest.build(leaves))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_chat": op3_chat,
    "op4_neighbours": op4_neighbours,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_packing": op7_packing,
    "op8_topk": op8_topk,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_digest_index": op11_digest_index,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_phrases": op13_phrases,
}
# Exact results that SQL can express; the other operators are tested against brute force.
ORACLES: dict[str, str] = {
    "op5_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
                ELSE [array_to_string(t[i:i + 4], ' ') for i in range(1, len(t) - 3)] END) AS g
            FROM words
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
        ), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other),
        least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
    """,
    "op8_topk": """
        WITH whole AS (
            SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum([q.v[i] * d.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
            FROM whole q JOIN whole d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_digest_index": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE crc AS (
            SELECT DISTINCT doc_id, xor(4294967295, list_reduce([4294967295] || [CAST(ascii(x) AS BIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')],
                lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS crc
            FROM documents
        ), fields AS (
            SELECT doc_id, source, text AS t, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
                || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
            FROM documents
        ), leaves AS (
            SELECT f.doc_id, source, sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS leaf,
                CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS bent
            FROM fields f LEFT JOIN crc ON crc.doc_id IS NOT DISTINCT FROM f.doc_id
        ), placed AS (
            SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY source) AS size, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
            FROM leaves
        ), below AS (
            SELECT tree, 0 AS level, pos, size, leaf AS hash FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 16, (size + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM below
            WHERE size > 1 GROUP BY tree, level, pos // 16, size
        ), above AS (
            SELECT 0 AS level, tree AS pos, (SELECT count(DISTINCT tree) FROM placed) AS size, hash FROM below WHERE size = 1
            UNION ALL
            SELECT level + 1, pos // 16, (size + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM above
            WHERE size > 1 GROUP BY level, pos // 16, size
        ), low_path AS (
            SELECT id, tree, 0 AS level, pos, size, coalesce(bent, leaf) AS folded, '' AS proof FROM placed
            UNION ALL
            SELECT p.id, p.tree, p.level + 1, p.pos // 16, (p.size + 15) // 16,
                sha256(string_agg(CASE WHEN n.pos = p.pos THEN folded ELSE hash END, '' ORDER BY n.pos)),
                proof || string_agg(CASE WHEN n.pos = p.pos THEN '' ELSE hash END, '' ORDER BY n.pos)
            FROM low_path p JOIN below n ON n.tree = p.tree AND n.level = p.level AND n.pos // 16 = p.pos // 16
            WHERE p.size > 1 GROUP BY p.id, p.tree, p.level, p.pos, p.size, folded, proof
        ), path AS (
            SELECT id, 0 AS level, tree AS pos, (SELECT count(DISTINCT tree) FROM placed) AS size, folded, proof FROM low_path WHERE size = 1
            UNION ALL
            SELECT p.id, p.level + 1, p.pos // 16, (p.size + 15) // 16,
                sha256(string_agg(CASE WHEN n.pos = p.pos THEN folded ELSE hash END, '' ORDER BY n.pos)),
                proof || string_agg(CASE WHEN n.pos = p.pos THEN '' ELSE hash END, '' ORDER BY n.pos)
            FROM path p JOIN above n ON n.level = p.level AND n.pos // 16 = p.pos // 16
            WHERE p.size > 1 GROUP BY p.id, p.level, p.pos, p.size, folded, proof
        ), top AS (SELECT hash AS root FROM above WHERE size = 1)
        SELECT doc_id, leaf, s.hash AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM placed JOIN below s ON s.tree = placed.tree AND s.size = 1 JOIN path ON path.id = placed.id AND path.size = 1, top
    """,
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS t FROM pieces),
        sizes AS (SELECT lang, CAST(sum(len(t)) AS BIGINT) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, k, unnest([array_to_string(t[i:i + k - 1], ' ') for i in range(1, len(t) - k + 2)]) AS phrase
            FROM words, range(1, 6) AS lengths(k) WHERE len(t) >= k
        ), uses AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
        parts AS (
            SELECT c.*, i, array_to_string(string_split(phrase, ' ')[1:i], ' ') AS head, array_to_string(string_split(phrase, ' ')[i + 1:], ' ') AS tail
            FROM uses c, range(1, 5) AS places(i) WHERE i < c.k
        ), cuts AS (
            SELECT c.lang, c.phrase, c.k, c.a, i, x.a AS l, y.a AS r, n, CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM parts c JOIN uses x ON x.lang = c.lang AND x.phrase = head JOIN uses y ON y.lang = c.lang AND y.phrase = tail
                JOIN sizes s ON s.lang = c.lang
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best b
            WHERE NOT EXISTS (SELECT 1 FROM uses m WHERE m.lang = b.lang AND m.k > b.k AND 100 * m.a >= 100 * b.a
                AND contains(' ' || m.phrase || ' ', ' ' || b.phrase || ' '))
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
