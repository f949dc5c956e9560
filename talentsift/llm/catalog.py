"""The operators over the sample tables: one query for each, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentsift.llm import (
    centroids,
    chat,
    decontaminate,
    lines,
    near_dups,
    packing,
    quality,
    repeats,
    spelling,
    token_counts,
    topk,
    toxicity,
    transducer,
)
from talentsift.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = token_counts.build_trees(table(spark, sf_dir, "documents"), BYTE_BPE)
    return token_counts.apply_edits(token_counts.redactions(trees), BYTE_BPE).drop("text", "leaf_chars", "leaf_tokens")


def op2_site_relative_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", lines.host_of(F.col("url")).alias("host"), lines.page_text(F.col("html")).alias("text"))
    return lines.drop_boilerplate(pages)


def op3_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


CONTROL_STRINGS = "</s>[INST] ok [/INST]"


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id bigint, turn bigint, role string, text string"
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_STRINGS), (-1, 1, "assistant", CONTROL_STRINGS)], columns)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(turns))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), BYTE_BPE)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op8_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text that they decode to, as digests; a null text is empty."""
    encoded = transducer.encode(table(spark, sf_dir, "documents"), BYTE_BPE)
    decoded = transducer.decode(encoded, BYTE_BPE)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the texts with its commonest spelling one edit away; documents without words add nothing."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector that takes part with its centroid after five rounds; the others give no row."""
    assigned, final = centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(assigned, final)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_aware_token_counts": op1_edit_aware_token_counts,
    "op2_site_relative_lines": op2_site_relative_lines,
    "op3_attention_quality": op3_attention_quality,
    "op4_threshold_top_k": op4_threshold_top_k,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_crf_toxicity": op8_crf_toxicity,
    "op9_block_max_wand": op9_block_max_wand,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_streaming_bpe": op11_streaming_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_centroid_clusters": op13_centroid_clusters,
}


def _centroid_sql(rounds: int) -> str:
    """The clustering as one statement: each round assigns, adds up and floors."""
    steps = [
        """v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER () AS r
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS (
            SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x AS c
            FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 40)
        )"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS (
            SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min(struct_pack(d := d, cluster := cluster)) AS best FROM (
                SELECT r, vec_id, x, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
                FROM v, c{k}) GROUP BY r
        )"""
        )
        if k < rounds:
            steps.append(
                f"""c{k + 1} AS (
            SELECT c{k}.cluster, coalesce(m.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
                SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM (
                    SELECT cluster, j, CAST(sum(e) AS BIGINT) AS s, count(*) AS n
                    FROM (SELECT best.cluster AS cluster, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM a{k}) GROUP BY cluster, j)
                GROUP BY cluster) m ON m.cluster = c{k}.cluster
        )"""
            )
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, best.cluster AS cluster, best.d AS distance,
            CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.cluster = best.cluster
    """

ORACLES: dict[str, str] = {
    "op2_site_relative_lines": r"""
        WITH texts AS (
            SELECT page_id, coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '') AS host, url,
                regexp_replace(regexp_replace(regexp_replace(html,
                    '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g'),
                    '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul)(?:\s[^>]*|/)?>', chr(10), 'g'),
                    '<[^>]+>', '', 'g') AS text,
                row_number() OVER () AS page
            FROM pages
        ), rows AS (
            SELECT page, host, line, pos FROM (
                SELECT page, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM texts)
        ), boilerplate AS (
            SELECT host, key FROM (SELECT DISTINCT page, host, trim(line, ' ') AS key FROM rows WHERE trim(line, ' ') <> '')
            JOIN (SELECT host, count(*) AS pages FROM texts GROUP BY host) USING (host)
            GROUP BY host, key HAVING count(*) >= 5 AND count(*) > max(pages) * 0.1
        ), marked AS (
            SELECT rows.*, boilerplate.key IS NOT NULL AS gone FROM rows
            LEFT JOIN boilerplate ON rows.host = boilerplate.host AND trim(line, ' ') = boilerplate.key
        )
        SELECT any_value(page_id) AS page_id, any_value(CASE WHEN url IS NOT NULL THEN texts.host END) AS host,
            any_value(CASE WHEN text IS NOT NULL THEN '' END) || coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
            count(line) AS n_lines, count(*) FILTER (gone) AS n_dropped
        FROM texts LEFT JOIN marked USING (page) GROUP BY page
    """,
    "op4_threshold_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, max(CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT)) AS score
            FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x) GROUP BY ALL
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
    "op6_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), ordered AS (
            SELECT *, row_number() OVER w AS ordinal,
                len(regexp_extract_all(text, '[0-9A-Za-z]+|[^0-9A-Za-z \t\n\r]')) + 4 AS cost,
                row_number() OVER w = 1 AND role = 'system' AS is_system
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), summed AS (
            SELECT *, greatest(1, (896 - max(CASE WHEN is_system THEN cost ELSE 0 END) OVER (PARTITION BY conv_id)) // 2) AS step,
                sum(CASE WHEN is_system THEN 0 ELSE cost END) OVER (PARTITION BY conv_id ORDER BY ordinal) AS sum_end
            FROM ordered
        ), windowed AS (
            SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY cell) AS win FROM (
                SELECT *, CASE WHEN is_system THEN 0 ELSE sum_end - cost END AS sum_begin,
                    CASE WHEN is_system THEN 0 ELSE (sum_end - cost) // step END AS cell
                FROM summed)
        ), placed AS (
            SELECT *, 1 + CASE WHEN is_system THEN windows - 1
                WHEN win < windows AND win_end - sum_begin <= 128 THEN 1 ELSE 0 END AS times
            FROM (SELECT *, max(win) OVER (PARTITION BY conv_id) AS windows, max(sum_end) OVER (PARTITION BY conv_id, win) AS win_end FROM windowed)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ordinal)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY ordinal), '')) AS loss_sha256,
            CAST(sum(times * (9 + length(role) + length(text)
                + length(regexp_replace(role || text, '[^\[\]<\\]', '', 'g')))) AS BIGINT) AS formatted_chars
        FROM placed GROUP BY conv_id
    """,
    "op13_centroid_clusters": _centroid_sql(5),
}
