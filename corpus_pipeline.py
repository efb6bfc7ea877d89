"""A corpus from raw documents to token ids, in stages that each read what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import byte_bpe, language, mixing, near_dedup, private_data
from logweave.llm.blocks import text_digest, with_ids
from logweave.llm.queries import surrogate_key
from logweave.session import kept_table, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure enough.

    Null and empty texts and those without letters go. A row is decided by its text, ``lang`` and ``source`` alone, so
    repeated rows and null ids stay or go like any. Other columns, whatever their names, are passed on.
    """
    # only 128 bits of rejected rows travel, the texts stay where they are
    hashes = {f"hash{i}": F.xxhash64(F.lit(i), "text", "lang", "source") for i in range(2)}
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "text", "lang", "source", *[v.alias(k) for k, v in hashes.items()])

    def rejected() -> DataFrame:
        found = language.document_languages(keyed, list(hashes))
        return found.filter("not accepted").select(*hashes).distinct()

    left = with_ids(keyed, kept_table(spark, "rejected-rows", rejected), list(hashes), "left_anti")
    return left.select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles: the smallest by id and digest of the text.

    Rows of one id and text are one document, of which the least row stays; rows that share an id but not
    the text are judged each by its own. Rows without id or words, also null texts, stay as they are, but for
    repeated ones with an id.
    """
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long"), text_digest(F.col("text")).alias("digest")
    )
    key = ["doc_id", "digest"]
    found = near_dedup.near_duplicates(docs, size=5, similarity=0.8)
    left = with_ids(keyed, materialize(found.filter("not first").select(*key), "dropped-rows"), key, "left_anti")
    repeated = found.filter("first and doc_id is not null").groupBy(*key).count().filter("count > 1").select(*key)
    repeated = materialize(repeated, "repeated-rows")
    if repeated.isEmpty():
        return left.select("row.*")
    order = [F.col(f"row.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    least = with_ids(left, repeated, key).groupBy(*key).agg(F.min_by("row", F.struct(*order)).alias("row"))
    return with_ids(left, repeated, key, "left_anti").select("row.*").union(least.select("row.*"))


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and secrets replaced.

    The secret behind replacements is the session's. Null and empty texts have none; repeated rows get the same replacements, null ids count like any.
    """
    return private_data.replace_private_data(docs, surrogate_key(spark), count=None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to source weights takes them.

    A null source is a source. Texts without words, also null ones, are not taken; rows that repeat id, source and
    number of words are taken equally often. Ties in the shuffle go by id and size.
    """
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining row, packed, and a digest of the text that they decode to.

    A null text counts as an empty one, which has no ids; every row has its own, also repeated ones.
    """
    ids = byte_bpe.encode_texts(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return ids.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("replace_private_data", replace_private_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# none of the statistics behind language, near-duplicate and replacement decisions fits into SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        # what a stage wrote on the way goes with it, and so does its input
        docs = kept_table(spark, f"pipeline-{name}", lambda given=docs, f=stage: f(spark, given, sf_dir))
    return docs
