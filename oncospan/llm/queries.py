"""Registered queries of the training-data operators, and their DuckDB statements where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.llm import (
    chat,
    cover_tree,
    embeddings,
    language,
    licenses,
    line_dedup,
    mixing,
    order_minhash,
    packing,
    pieces,
    quality,
    whitening,
)
from oncospan.llm.common import Scratch
from oncospan.llm.jaccard import JaccardJoin

TOKENIZER = "word_bpe_49k.json"
PIECES, END_PIECE = "piece_bpe_32k.model", 2
MIX_POWER = 0.9  # target shares are the margins of tokens ** MIX_POWER over (source, language, topic)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """Trained on the rows outside the held-out fold: good labels, and documents without their labels."""
    good = (labels.filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("low"))
            .filter("low = 1").select("doc_id"))
    return quality.fit(docs.filter(~held_out()), good)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "pages"), Scratch(spark))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def pack_documents(spark: SparkSession, docs: DataFrame, cache_words: int = packing.CACHE_WORDS) -> DataFrame:
    vocabulary = packing.read_text(public_tokenizers.path(TOKENIZER))
    pieces = packing.pack(docs, Scratch(spark), vocabulary, cache_words=cache_words)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), Scratch(spark))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = JaccardJoin(Scratch(spark), words=4, num=85, den=100)
    return join.groups(table(spark, sf_dir, "documents"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and its edited text: the last half replaced by as much of the next document's start."""
    rows = order_minhash.fingerprints(table(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    rows = order_minhash.with_sketches(rows.drop("text", "next_text"), "edited", "edited_sketches")
    own = F.col("sketches")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_text(own).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_sketches")).alias("edited_fingerprint"),
        order_minhash.likeness(own, F.col("edited_sketches")).alias("near_edited"),
        order_minhash.likeness(own, F.col("next_sketches")).alias("near_next"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, raked weight, probability and draw."""
    scratch = Scratch(spark)
    _, measured = mixing.measure(table(spark, sf_dir, "documents"), scratch)
    return mixing.fit(measured, scratch, power=MIX_POWER, temper="cells").decide(measured)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"), Scratch(spark))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, Scratch(spark))
    return kept.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2("text", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of five positives of every hundredth vector; every seventh label is moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return cover_tree.mine(rows, Scratch(spark), F.col("vec_id") % 100 == 0)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to, as digests."""
    model = pieces.PieceModel.read(public_tokenizers.path(PIECES))
    docs = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model, END_PIECE), model)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return whitening.whiten(rows, Scratch(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_pack": op2_pack,
    "op3_language": op3_language,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_order_minhash": op5_order_minhash,
    "op6_mix": op6_mix,
    "op7_chat": op7_chat,
    "op8_line_dedup": op8_line_dedup,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pieces": op12_pieces,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op7_chat": """
WITH placed AS (
    SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
                              coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
    SELECT conv_id, count(*) AS turns, list({'r': role, 't': text} ORDER BY place) AS said,
           string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                      || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
    FROM placed GROUP BY conv_id),
whole AS (
    SELECT min(conv_id) AS conv_id, turns, said, text, count(*) AS copies FROM conv GROUP BY turns, said, text),
inner_of AS (
    SELECT DISTINCT a.conv_id FROM whole a JOIN whole b
    ON a.said[1] = b.said[1] AND a.turns < b.turns AND a.said = b.said[1:a.turns])
SELECT conv_id, 0 AS part, turns, copies, text FROM whole
WHERE conv_id NOT IN (SELECT conv_id FROM inner_of)""",
    "op1_embedding_dedup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0
      AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS n_links, r.component_id,
       e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = e.vec_id""",
    "op4_ngram_jaccard": """
WITH RECURSIVE word AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id,
           unnest(list_transform(range(1, greatest(1, len(w) - 3) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
    FROM word WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
    SELECT c.a, c.b FROM common c JOIN size x ON x.doc_id = c.a JOIN size y ON y.doc_id = c.b
    WHERE 100 * overlap >= 85 * (x.n + y.n - overlap)),
reach AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION
    SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id""",
    "op8_line_dedup": """
WITH line AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
repeated AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING min(doc_id) <> max(doc_id)),
judged AS (
    SELECT k.doc_id, k.n, k.line, coalesce(r.first_doc <> k.doc_id, false) AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op11_hard_negatives": """
WITH usable AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND list_sum(list_transform(embedding, lambda c: CASE WHEN c IS NULL OR NOT isfinite(c) THEN 1 ELSE 0 END)) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
placed AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    WHERE 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM placed WHERE rank <= 5""",
}
