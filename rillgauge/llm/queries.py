"""The registered queries of the corpus operators over the given tables, and their plain SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillgauge.llm import (
    bpe, counts, covertree, dialogue, exact, langid, mixing, ordermin, packing, phrases, planes, secrets, substring,
)
from rillgauge.llm.common import table
from rillgauge.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP1_SQL = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS len,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(content) AS text_sha256
FROM n
WINDOW best AS (PARTITION BY content ORDER BY len DESC, doc_id)
"""


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_RANKS, public_tokenizers.PATTERN)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("token_ids").alias("ids_crc32")))


def op6_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "planes")
    planes.write(table(spark, sf_dir, "documents"), folder, BYTE_BPE, BYTE_RANKS, public_tokenizers.PATTERN)
    return planes.read(spark, folder).select(
        "doc_id", "start", F.expr("cast(octet_length(token_ids) div 4 as bigint)").alias("n_tokens"),
        F.crc32("token_ids").alias("ids_crc32"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.id_digests(bpe.encode(docs, BYTE_BPE, BYTE_RANKS, public_tokenizers.PATTERN))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *(secrets.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
    )) AS piece FROM documents
), worded AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), occurring AS (
    SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i : i + size - 1], ' '))) AS phrase
    FROM worded, (VALUES (1), (2), (3)) sizes (size)
), f AS (
    SELECT lang, size, phrase, count(*)::HUGEINT AS n FROM occurring GROUP BY ALL
), c AS (
    SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 10
), cuts AS (
    SELECT lang, size, phrase, a, words, unnest(range(1, size)) AS k FROM c
), scored AS (
    SELECT cuts.*, fl.n AS l, fr.n AS r, 1000000 * a * a // (fl.n * fr.n) AS score
    FROM cuts
    JOIN f fl ON fl.lang = cuts.lang AND fl.size = k AND fl.phrase = array_to_string(words[1 : k], ' ')
    JOIN f fr ON fr.lang = cuts.lang AND fr.size = cuts.size - k AND fr.phrase = array_to_string(words[k + 1 : ], ' ')
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
    SELECT lang, unnest([array_to_string(words[1 : 2], ' '), array_to_string(words[2 : 3], ' ')]) AS phrase, a FROM c WHERE size = 3
), kept AS (
    SELECT worst.* FROM worst LEFT JOIN (SELECT lang, phrase, max(a) AS more FROM held GROUP BY ALL) h USING (lang, phrase)
    WHERE coalesce(100 * more < 50 * a, true)
), totals AS (
    SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    quality = labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality)


OP12_SQL = r"""
WITH best AS (
    SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS w
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 13) AS digits
    FROM documents
), r AS (
    SELECT d.doc_id, source, size,
           -ln((('0x' || digits)::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(w, 1.0::DOUBLE) AS rank
    FROM d LEFT JOIN best USING (doc_id)
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap FROM r GROUP BY source
), n AS (
    SELECT *, ([5.0::DOUBLE, 2.0, 1.0])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM s
), o AS (
    SELECT *, row_number() OVER k AS i,
           (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
               - coalesce(sum(cap) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS remains,
           sum(w) OVER () - coalesce(sum(w) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS weights
    FROM n WINDOW k AS (ORDER BY cap / w, source ASC NULLS LAST)
), level AS (
    SELECT arg_min(remains, i) AS remains, arg_min(weights, i) AS weights FROM o WHERE w * remains / weights < cap
), t AS (
    SELECT source, source_size, coalesce(least(cap, w * level.remains / level.weights), cap) AS target FROM o LEFT JOIN level ON true
), e AS (
    SELECT *, floor(target + 0.5)::BIGINT AS whole,
           CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM t
), c AS (
    SELECT r.*, source_size, target, epochs, whole - epochs * source_size AS rest,
           coalesce(sum(size) OVER (
               PARTITION BY r.source ORDER BY rank, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
           ), 0) AS before
    FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(least(rest - before, size), 0))::BIGINT AS taken FROM c
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return dialogue.report(rows, dialogue.Repair(dialogue.damaged(rows)))


# The states of the recursion are 0 (nothing yet), 1 (after s), 2 (after u) and 3 (after a); it goes backward over the rows.
OP13_SQL = r"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
), hashed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_transform(range(1, length(name) + 1), lambda i: ord(name[i])::BIGINT),
        lambda crc, byte: list_reduce(range(8)::BIGINT[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
        4294967295
    )) % 20 AS kind FROM named
), hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS c
    FROM hurt
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
           coalesce(lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au'), false) AS wrong
    FROM placed
), steps AS (
    SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late, coalesce(fault IN ('blank', 'duplicate'), false) AS gone FROM judged
), way AS (
    SELECT DISTINCT conv_id, n + 1 AS i, {'cost': 0, 'edits': '', 'rows': []::VARCHAR[]} AS s0,
           {'cost': 6, 'edits': 'II', 'rows': ['user:', 'assistant:']} AS s1,
           {'cost': 3, 'edits': 'I', 'rows': ['assistant:']} AS s2, {'cost': 0, 'edits': '', 'rows': []::VARCHAR[]} AS s3
    FROM steps
    UNION ALL
    SELECT conv_id, i,
           least(b0, {'cost': 3 + f2.cost, 'edits': 'I' || f2.edits, 'rows': list_prepend('user:', f2.rows)}),
           least(b1, {'cost': 3 + f2.cost, 'edits': 'I' || f2.edits, 'rows': list_prepend('user:', f2.rows)}), f2, f3
    FROM (
        SELECT conv_id, i, b0, b1,
               least(b2, {'cost': 3 + b3.cost, 'edits': 'I' || b3.edits, 'rows': list_prepend('assistant:', b3.rows)}) AS f2,
               least(b3, {'cost': 3 + b2.cost, 'edits': 'I' || b2.edits, 'rows': list_prepend('user:', b2.rows)}) AS f3
        FROM (
            SELECT x.conv_id, x.i,
                   list_min([d0, k0s, k0u, r0]) AS b0, list_min([d1, k1, r0]) AS b1, list_min([d2, k2, r2]) AS b2, list_min([d3, k3, r0]) AS b3
            FROM (
                SELECT t.conv_id, t.i,
                       {'cost': 4 + s0.cost, 'edits': 'D' || s0.edits, 'rows': s0.rows} AS d0,
                       {'cost': 4 + s1.cost, 'edits': 'D' || s1.edits, 'rows': s1.rows} AS d1,
                       {'cost': 4 + s2.cost, 'edits': 'D' || s2.edits, 'rows': s2.rows} AS d2,
                       {'cost': 4 + s3.cost, 'edits': 'D' || s3.edits, 'rows': s3.rows} AS d3,
                       CASE WHEN NOT gone AND c = 's' THEN {'cost': late + s1.cost, 'edits': 'K' || s1.edits, 'rows': list_prepend(role || ':' || text, s1.rows)} END AS k0s,
                       CASE WHEN NOT gone AND c = 'u' THEN {'cost': late + s2.cost, 'edits': 'K' || s2.edits, 'rows': list_prepend(role || ':' || text, s2.rows)} END AS k0u,
                       k0u AS k1, k0u AS k3,
                       CASE WHEN NOT gone AND c = 'a' THEN {'cost': late + s3.cost, 'edits': 'K' || s3.edits, 'rows': list_prepend(role || ':' || text, s3.rows)} END AS k2,
                       CASE WHEN NOT gone THEN {'cost': 3 + late + s2.cost, 'edits': 'R' || s2.edits, 'rows': list_prepend('user:' || text, s2.rows)} END AS r0,
                       CASE WHEN NOT gone THEN {'cost': 3 + late + s3.cost, 'edits': 'R' || s3.edits, 'rows': list_prepend('assistant:' || text, s3.rows)} END AS r2
                FROM way JOIN steps t ON t.conv_id IS NOT DISTINCT FROM way.conv_id AND t.i = way.i - 1
            ) x
        )
    )
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (wrong) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.cost, 0)::BIGINT AS cost,
       coalesce(s0.edits, '') AS audit, sha256(coalesce(array_to_string(s0.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN way ON way.conv_id IS NOT DISTINCT FROM o.conv_id AND way.i = 1
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_token_planes": op6_token_planes,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_secret_scan": op10_secret_scan,
    "op11_phrases": op11_phrases,
    "op12_source_mix": op12_source_mix,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op11_phrases": OP11_SQL,
    "op12_source_mix": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
