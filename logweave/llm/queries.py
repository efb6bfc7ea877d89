"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import warnings

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import (
    byte_bpe,
    curve_search,
    exact_topk,
    filter_audit,
    language,
    mixing,
    near_dedup,
    private_data,
    suffix_dedup,
    term_pipeline,
    token_counts,
    toxicity,
    url_filters,
)

# names the secret behind surrogates; Spark hides settings with "secret" in their names from its logs
SURROGATE_SETTING = "spark.logweave.surrogate.secret"
# stands for it where the setting is missing, as in tests; anyone could work out surrogates made with it
SURROGATE_KEY = b"replace-me"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogate_key(spark: SparkSession) -> bytes:
    """The session's secret for surrogates; a warning and the placeholder where there is none or an empty one."""
    secret = spark.conf.get(SURROGATE_SETTING, None)
    if not secret:
        warnings.warn(f"{SURROGATE_SETTING} is not set: surrogates can be guessed", stacklevel=2)
        return SURROGATE_KEY
    return secret.encode()


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the sentencepiece model."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows by integer inner product for every 50th id."""
    return exact_topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a lexicon learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.learn_lexicon(docs, labels.filter(~toxicity.held_out()))
    scored = toxicity.score_toxicity(docs, lexicon, 0.3)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without its strings of 200 bytes that start elsewhere too."""
    rest = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 200)
    return rest.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    encoded = byte_bpe.encode_texts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their three-word shingles."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, similarity=0.85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data and secrets replaced."""
    return private_data.replace_private_data(table(spark, sf_dir, "documents"), surrogate_key(spark))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents by source weights takes of each."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op9_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every 20th id."""
    return curve_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, and whether it is sure enough to keep the document."""
    return language.document_languages(table(spark, sf_dir, "documents"), ["doc_id"])


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, with the text model of the documents."""
    model = language.fit_text_model(table(spark, sf_dir, "documents"))
    return language.page_languages(table(spark, sf_dir, "pages"), model)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return term_pipeline.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


# Host, path and verdict of the rules that pages are judged by
URL_RULES = """
SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow') AS rules(host, path, verdict)
"""


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged = url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), spark.sql(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by language."""
    cells = filter_audit.contingency(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit_orders(cells)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_exact_top_k,
        op3_toxicity,
        op4_suffix_dedup,
        op5_byte_bpe,
        op6_near_dedup,
        op7_private_data,
        op8_mixing,
        op9_curve_search,
        op10_language_id,
        page_language_id,
        op11_ranked_search,
        op12_url_filters,
        op13_filter_audit,
    )
}

ORACLES = {
    "op2_exact_top_k": exact_topk.TOP_K_SQL,
    "op8_mixing": mixing.MIX_SQL,
    "op11_ranked_search": term_pipeline.RANK_SQL,
    "op12_url_filters": url_filters.URL_SQL,
    "op13_filter_audit": filter_audit.AUDIT_SQL,
}
