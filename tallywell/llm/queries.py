"""The training-data operators with production parameters, on their whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm import chat, decontaminate, html_text, line_dedup, mixing, near_dedup, quality, secrets, sharding
from tallywell.llm import hard_negatives, lexical, packing, token_store
from tallywell.session import table

#: Rows per Arrow batch: texts may be long, and a batch of them is held in memory.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table for operators that hand texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return table(spark, sf_dir, name)


def vocabulary(name: str = "byte_bpe_50k.json") -> tuple[str, str]:
    """File of a public tokenizer, and the pattern that its texts are split by."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_documents(
        read(spark, sf_dir, "documents"), lambda: token_store.byte_bpe(*vocabulary())
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(mixing.size_documents(read(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.format_and_read(turns)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        hard_negatives.whole_vector(F.col("embedding")).alias("embedding"),
    )
    return hard_negatives.mine_negatives(rows, "vec_id % 100 = 0")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")[0]
    packed = packing.pack_documents(read(spark, sf_dir, "documents"), lambda: packing.word_bpe(path))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_text, op2_decontaminate, op3_token_store, op4_secrets, op5_mixing, op6_line_dedup, op7_chat, op8_quality,
        op9_near_dedup, op10_sharding, op11_hard_negatives, op12_packing, op13_lexical,
    )
}

ORACLE: dict[str, str] = {
    "op5_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
            FROM sized GROUP BY source),
        running AS (
            SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
                   coalesce(sum(source_size) OVER o, 0) AS filled, coalesce(sum(w) OVER o, 0) AS passed
            FROM sources
            WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (
            SELECT *, 3 * source_size * (weights - passed) <= (total - 3 * filled) * w AS is_full FROM running),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
                        ELSE CAST((total - 3 * sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER ()) * w AS DOUBLE)
                             / CAST(weights - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER () AS DOUBLE) END AS target
            FROM marked),
        ranked AS (
            SELECT s.doc_id, s.size, t.source_size, t.target,
                   coalesce(t.target / nullif(CAST(t.source_size AS DOUBLE), 0), 0) AS rate,
                   CAST(CAST('0x' || substr(md5('7:' || coalesce(s.source, chr(0) || 'null')), 1, 8) AS BIGINT) AS DOUBLE)
                       / 4294967296.0 AS u,
                   row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) - 1 AS k
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(size * least(floor((k + 1) * rate + u) - floor(k * rate + u), 3) AS BIGINT) AS taken
        FROM ranked""",
    "op6_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, l.line AS line, l.place AS place,
                   translate(trim(l.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
                                                       lambda x, i: {'line': x, 'place': i})) AS l
                  FROM documents)),
        shared AS (
            SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        judged AS (
            SELECT l.doc_id, l.line, l.place, s.first IS NOT NULL AND s.first <> l.doc_id AS lost
            FROM lines l LEFT JOIN shared s ON l.key = s.key)
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(lost AS INT)) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op7_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op11_hard_negatives": r"""
        WITH rows AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
         AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= 10""",
    "op13_lexical": r"""
        WITH asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        docs AS (
            SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        sizes AS (SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
        held AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM held, totals GROUP BY term, n_docs),
        scored AS (
            SELECT a.item_id, s.doc_id, s.d,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked a JOIN held h ON a.term = h.term JOIN weights v ON v.term = a.term JOIN sizes s ON s.d = h.d, totals
            GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
