"""The queries of this subpackage on the test tables, and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.llm.common import ship_code
from stepwise.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@_query
def op6_repetition(spark, folder):
    from stepwise.llm.quality import repetition

    return repetition(_table(spark, folder, "documents"))


@_query
def op7_exact_dedup(spark, folder):
    from stepwise.llm.exact_dedup import exact_groups

    return exact_groups(_table(spark, folder, "documents"))


@_query
def op8_preferences(spark, folder):
    """Chosen: each conversation. Rejected: its first turns, continued by another conversation (see ``spliced``)."""
    from stepwise.llm.preference import format_preferences, spliced, turns

    chosen = turns(_table(spark, folder, "conversations"), "conv_id")
    pairs = format_preferences(chosen, spliced(chosen))
    flat = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        "prompt",
        "chosen",
        "rejected",
        flat("chosen_spans").alias("chosen_spans"),
        flat("rejected_spans").alias("rejected_spans"),
    )


ORACLES["op8_preferences"] = """
WITH numbered AS (
    SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), plan AS (
    SELECT conv_id, ('0x' || substr(md5(conv_id::VARCHAR), 1, 4))::BIGINT % n AS kept,
           coalesce(lead(conv_id) OVER w, min(conv_id) OVER (PARTITION BY floor(conv_id / 1024))) AS partner
    FROM (SELECT conv_id, count(*) AS n FROM numbered GROUP BY 1)
    WINDOW w AS (PARTITION BY floor(conv_id / 1024) ORDER BY conv_id)
), sides AS (
    SELECT conv_id, 'c' AS side, pos, role, text FROM numbered
    UNION ALL SELECT conv_id, 'r', pos, role, text FROM numbered JOIN plan USING (conv_id) WHERE pos <= kept
    UNION ALL SELECT p.conv_id, 'r', pos, role, text FROM plan p JOIN numbered n ON n.conv_id = p.partner
      WHERE p.partner <> p.conv_id AND pos > kept
), compared AS (
    SELECT conv_id, pos, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM sides GROUP BY 1, 2
), cut AS (
    SELECT conv_id, coalesce(min(pos) FILTER (NOT same) - 1, max(pos)) AS prompt_turns FROM compared GROUP BY 1
), placed AS (
    SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown FROM sides JOIN cut USING (conv_id)
), summed AS (
    SELECT *, sum(CASE WHEN pos > prompt_turns THEN length(shown) END) OVER (PARTITION BY conv_id, side ORDER BY pos) AS stop FROM placed
), spans AS (
    SELECT *, CASE WHEN pos > prompt_turns AND role = 'assistant'
      THEN (stop - length(shown) + length(role) + 5)::VARCHAR || '-' || (stop - 1)::VARCHAR END AS span FROM summed
)
SELECT conv_id, min(prompt_turns)::BIGINT AS prompt_turns,
       coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 'c' AND pos <= prompt_turns), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 'c' AND pos > prompt_turns), '') AS chosen,
       coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 'r' AND pos > prompt_turns), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 'c'), '') AS chosen_spans,
       coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 'r'), '') AS rejected_spans
FROM spans GROUP BY conv_id
"""


@_query
def op10_warc(spark, folder):
    from stepwise.llm.warc import parse_records, read_records, write_archive

    archive = shared_dir(spark, "warc")
    write_archive(_table(spark, folder, "pages"), archive)
    return parse_records(read_records(spark, archive))


ORACLES["op10_warc"] = """
WITH p AS (
    SELECT page_id, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
    SELECT digest, min(page_id) AS first_page FROM p GROUP BY digest
)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM p JOIN f ON p.digest = f.digest
"""


@_query
def op1_token_files(spark, folder):
    import public_tokenizers

    from stepwise.llm.token_files import read_tokens, write_tokens

    out = shared_dir(spark, "tokens")
    write_tokens(_table(spark, folder, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_tokens(spark, out)


@_query
def op4_line_chunks(spark, folder):
    from stepwise.llm.line_dedup import clean_lines

    docs = _table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return clean_lines(docs).select(
        "doc_id", "chunks_removed", "lines_removed", F.octet_length("text").cast("long").alias("bytes_left"), F.crc32("text").alias("text_crc32")
    )


@_query
def op5_packing(spark, folder):
    import public_tokenizers

    from stepwise.llm.packing import pack_documents

    return pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


@_query
def op9_jaccard(spark, folder):
    from stepwise.llm.jaccard import near_groups

    return near_groups(_table(spark, folder, "documents"))


@_query
def op3_recurrent_lm(spark, folder):
    from stepwise.llm.lm import score_documents

    return score_documents(_table(spark, folder, "documents"))


@_query
def op2_sampled_pieces(spark, folder):
    import public_tokenizers

    from stepwise.llm.segment import sample_segmentations

    return sample_segmentations(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 2)


@_query
def op13_hard_negatives(spark, folder):
    from stepwise.llm.lemp import hard_negatives

    rows = _table(spark, folder, "embeddings")
    return hard_negatives(rows.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")))


ORACLES["op13_hard_negatives"] = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""


@_query
def op11_ranked_search(spark, folder):
    from stepwise.llm.lexical import rank_documents

    return rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op11_ranked_search"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), sized AS (
    SELECT r, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0
), total AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized
), posting AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM sized) GROUP BY r, term
), weight AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM posting, total GROUP BY term, docs
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, r, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN posting USING (term) JOIN sized USING (r), total GROUP BY item_id, r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored JOIN sized USING (r) WHERE score > 0
QUALIFY rank <= 10
"""


@_query
def op12_language(spark, folder):
    from stepwise.llm.langid import predict_languages

    return predict_languages(_table(spark, folder, "documents"))
