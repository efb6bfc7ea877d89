"""Odd rows, empty tables and columns that carry the operators' own names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import (
    byte_bpe, curve_search, exact_topk, language, mixing, near_dedup, private_data, suffix_dedup, token_counts, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string"
LONG = "the quick brown fox jumps over the lazy dog and then runs away from it " * 3000
ROWS = [
    (1, LONG, "en", "a"), (2, LONG, "en", None), (3, "", "en", "a"), (4, None, None, "b"), (None, "no id", "en", "b"),
    (5, "call 644-555-8547 now", None, None), (5, "call 644-555-8547 now", None, None), (None, None, None, None),
]
NAMES = [
    "n_tokens", "ids", "decoded", "kept", "n_removed", "component_id", "n_shingles", "size", "target", "taken", "score",
    "predicted", "language", "accepted", "n_replaced", "rank", "query_id", "key", "value", "kind", "count", "row", "block",
    "id", "piece", "words", "host", "label", "toxic",
]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

OPERATORS = {
    "token_counts": (lambda d: token_counts.count_tokens(d, public_tokenizers.path("piece_bpe_32k.model")), "n_tokens"),
    "toxicity": (lambda d: toxicity.score_toxicity(d, toxicity.learn_lexicon(d, labels_of(d))), "predicted"),
    "suffix_dedup": (lambda d: suffix_dedup.remove_repeats(d, 200), "kept"),
    "byte_bpe": (lambda d: byte_bpe.encode_texts(d, RANKS, public_tokenizers.PATTERN), "n_tokens"),
    "near_dedup": (lambda d: near_dedup.near_duplicates(d, 5, 0.8), "component_id"),
    "private_data": (lambda d: private_data.replace_private_data(d, b"k"), "text"),
    "mixing": (mixing.mix_report, "taken"),
    "language": (lambda d: language.document_languages(d, ["doc_id"]), "accepted"),
}


def labels_of(docs):
    return docs.select("doc_id", F.lit(0).alias("toxic"))


def wide(df):
    return df.withColumns({n: F.lit("x") for n in NAMES if n not in df.columns})


@pytest.mark.parametrize("name", list(OPERATORS))
def test_rows_of_every_kind(spark, name):
    operator, column = OPERATORS[name]
    docs = spark.createDataFrame(ROWS, SCHEMA)

    def found(df):
        return sorted((repr(r["doc_id"]), repr(r[column])) for r in operator(df).select("doc_id", column).collect())

    plain = found(docs)
    assert len(plain) == len(ROWS)
    assert found(wide(docs)) == plain
    assert found(docs.limit(0)) == []


@pytest.mark.parametrize("search", [exact_topk.exact_top_k, curve_search.nearest])
def test_searches_with_clashing_columns_and_no_rows(spark, search):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, 0.0]), (3, None), (4, [1.0, None]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def found(df):
        return sorted(tuple(r) for r in search(df, F.col("vec_id") % 2 == 0, 2).select("query_id", "rank", "vec_id").collect())

    plain = found(table)
    assert plain == [(0, 1, 1), (0, 2, 2), (2, 1, 0), (2, 2, 1)]
    assert found(wide(table)) == plain
    assert found(table.limit(0)) == []


def test_pipeline_stages_take_rows_of_every_kind(spark):
    sf_dir = "/root/testdata/sf0.001"
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    known = {f.name: f.dataType for f in columns}
    docs = spark.createDataFrame(ROWS, SCHEMA)
    docs = docs.select(*[(F.col(n) if n in docs.columns else F.lit(None)).cast(t).alias(n) for n, t in known.items()])
    for name, stage in corpus_pipeline.STAGES:
        for given in (wide(docs), docs.limit(0)):
            out = stage(spark, given, sf_dir)
            assert name == "encode" or out.columns == given.columns
            n = out.count()
            assert n <= 3 * len(ROWS) if given.columns != docs.columns else n == 0
