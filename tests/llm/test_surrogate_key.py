"""The secret behind surrogates comes from the session."""

import pytest

import corpus_pipeline
from logweave.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def replaced(spark):
    docs = spark.createDataFrame([(1, "Write to anna.miller@example.org today", "en", "web", 38)], SCHEMA)
    return corpus_pipeline.replace_private_data(spark, docs, "").first()["text"]


def test_secret_decides_surrogates(spark):
    with pytest.warns(UserWarning, match="can be guessed"):
        placeholder = replaced(spark)
    found = []
    try:
        for secret in ("first secret", "second secret", "first secret"):
            spark.conf.set(queries.SURROGATE_SETTING, secret)
            assert queries.surrogate_key(spark) == secret.encode()
            found.append(replaced(spark))
    finally:
        spark.conf.unset(queries.SURROGATE_SETTING)
    assert found[0] == found[2] and len({placeholder, *found}) == 3
    assert all("anna.miller@example.org" not in text for text in [placeholder, *found])


def test_empty_secret_is_none(spark):
    spark.conf.set(queries.SURROGATE_SETTING, "")
    try:
        with pytest.warns(UserWarning, match="can be guessed"):
            assert queries.surrogate_key(spark) == queries.SURROGATE_KEY
    finally:
        spark.conf.unset(queries.SURROGATE_SETTING)
