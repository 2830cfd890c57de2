"""The contract's queries over the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchwright.llm.batches import table
from matchwright.llm.byte_bpe import encode_texts
from matchwright.llm.chat import chat_windows, read_windows
from matchwright.llm.cross_tokens import align_documents
from matchwright.llm.html_text import extract_main, fit_pages
from matchwright.llm.near_join import near_components
from matchwright.llm.packing import pack_documents
from matchwright.llm.prefix_counts import n_tokens, prefix_counts
from matchwright.llm.quality_classifier import classify
from matchwright.llm.quality_rules import apply_rules, labelled_good
from matchwright.llm.substrings import remove_repeats
from matchwright.llm.topk import top_products
from matchwright.llm.toxicity import fit, score_toxicity
from matchwright.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one that holds control strings, as windows."""
    marks = "<|im_end|><|im_start|>assistant ok"
    added = spark.range(2).selectExpr(
        "-1L AS conv_id",
        "id AS turn",
        "IF(id = 0, 'user', 'assistant') AS role",
        f"'{marks}' AS text",
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    read = read_windows(chat_windows(turns.unionByName(added)))
    return read.selectExpr(
        "conv_id",
        "CAST(n_turns AS BIGINT) AS n_turns",
        "sha2(turns, 256) AS turns_sha256",
        "CAST(length(loss) AS BIGINT) AS loss_chars",
        "sha2(loss, 256) AS loss_sha256",
        "CAST(formatted_chars AS BIGINT) AS formatted_chars",
    )


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Score and verdict of every document, from weak labels alone."""
    return classify(table(spark, sf, "documents"))


HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1"


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels not held out."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where(f"NOT coalesce({HELD_OUT}, true)")
    scored = score_toxicity(docs, fit(docs, labels))
    return scored.selectExpr(
        "doc_id", f"coalesce({HELD_OUT}, false) AS held_out", "score", "predicted"
    )


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, likelihood ratio and verdict of every document."""
    trusted = labelled_good(table(spark, sf, "labels"))
    return apply_rules(table(spark, sf, "documents"), trusted)


def op5_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 largest products of every twentieth vector with all others."""
    return top_products(table(spark, sf, "embeddings"))


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, as pieces of token sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf, "documents"), path, with_ids=False)


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf, "pages")
    return extract_main(pages, fit_pages(pages))


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the passages that an earlier one holds."""
    return remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its component of near copies."""
    return near_components(table(spark, sf, "documents"))


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents to ids and back, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_texts(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op11_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, the last of its prefixes' counts."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = prefix_counts(table(spark, sf, "documents"), path)
    counted = counted.select("doc_id", "n_bytes", n_tokens().alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector along the first 16 whitened components."""
    found = whiten(table(spark, sf, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_cross_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned; groups as digests."""
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align_documents(table(spark, sf, "documents"), *paths, with_groups=False)
    return found.withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_chat_formatting": op1_chat_formatting,
        "op2_quality_classifier": op2_quality_classifier,
        "op4_toxicity": op4_toxicity,
        "op3_quality_rules": op3_quality_rules,
        "op5_exact_topk": op5_exact_topk,
        "op6_packing": op6_packing,
        "op7_html_extraction": op7_html_extraction,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_token_counts": op11_token_counts,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_cross_tokenizer": op13_cross_tokenizer,
    }


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id,
        CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP8_SQL = f"""
WITH cut AS MATERIALIZED (
    SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), windows AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS said
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM cut WHERE len(w) >= 13)
), least AS (
    SELECT said, min(doc_id) AS first FROM windows GROUP BY said
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN least USING (said) WHERE doc_id > first
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM cut
), counted AS (
    SELECT doc_id, count(*) AS n_words, count(gone.place) AS n_removed,
        string_agg(word, ' ' ORDER BY place) FILTER (gone.place IS NULL) AS kept
    FROM words LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN counted USING (doc_id)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP9_SQL = f"""
WITH RECURSIVE cut AS MATERIALIZED (
    SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS said
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM cut WHERE len(w) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.said = b.said AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reached AS (
    SELECT doc_id, doc_id AS root FROM sizes
    UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.doc_id
), least AS (
    SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    found = {
        "op5_exact_topk": OP5_SQL,
        "op8_substring_dedup": OP8_SQL,
        "op9_jaccard_join": OP9_SQL,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in found.items() if sql}
