"""The corpus operators against brute force, on small tables with odd rows."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import (
    byte_bpe, components, curve_search, exact_topk, hilbert, language, mixing, near_dedup, private_data,
    suffix_dedup, token_counts, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long"
LONG = "the quick brown fox jumps over the lazy dog and runs away " * 40
TEXTS = [
    None, "", " ", "\n\n", "one", "two words", "ﬁ ①  x\r\n\ty", "a▁b <s>", "aaaaaaaaaaaaaaaaaaaaaaaaa" * 60, LONG, LONG,
    LONG.upper(), "x" + LONG + "y", "Ünïcödé ñandú 東京 🙂🙂 don't it's 12345", "write to Ann.Lee@mail.example.com or 10.1.2.3",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 4}", 1, 0.5, 7) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", None, None, None, None, None), (3, "\n\n", "en", "s3", 1, 0.5, 7)]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_token_counts(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = by_id(token_counts.count_tokens(docs, path, limit=500))
    for i, text in enumerate(TEXTS):
        n = len(model.encode(text or ""))
        assert (found[i]["n_tokens"], found[i]["over_limit"]) == (n, n > 500)
        assert found[i]["n_bytes"] == len((text or "").encode())


def test_byte_bpe(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN))
    for i, text in enumerate(TEXTS):
        assert np.frombuffer(found[i]["ids"], "<u4").tolist() == own.encode_ordinary(text or "")
        assert found[i]["decoded"] == (text or "").encode()


def test_suffix_dedup(docs):
    texts = [(t or "").encode() for t in [*TEXTS, "no id here", "\n\n"]]
    count = Counter(t[s : s + 20] for t in texts for s in range(len(t) - 19))
    found = by_id(suffix_dedup.remove_repeats(docs, 20))
    for i, text in enumerate(texts[: len(TEXTS)]):
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - 19):
            if count[text[s : s + 20]] > 1:
                gone[s : s + 20] = True
        assert found[i]["kept"] == np.frombuffer(text, np.uint8)[~gone].tobytes()


def test_suffix_dedup_keeps_texts_apart_that_share_a_short_hash(spark):
    texts = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("text"))
    hashed = texts.withColumn("h", F.hash("text")).groupBy("h").agg(F.collect_list("text").alias("texts"))
    one, other = sorted(hashed.filter("size(texts) > 1").orderBy("h").first()["texts"])[:2]
    rows = [(None, one), (None, other), (1, one[10:50])]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    assert sorted(bytes(r["kept"]).decode() for r in found) == sorted(["", one[:10] + one[50:], other])


def test_near_duplicates(docs, spark):
    found = by_id(near_dedup.near_duplicates(docs, 3, 0.85))
    assert [found[i]["component_id"] for i in (9, 10, 11, 12)] == [9, 9, 9, 9]
    assert all(found[i]["component_id"] == i for i in range(9)) and found[None]["kept"]
    assert near_dedup.near_duplicates(docs.limit(0), 3, 0.85).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["id"]: r["component"] for r in components.connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_search(spark):
    random = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(random.standard_normal((300, 8)).tolist())]
    rows += [(300, rows[0][1]), (301, None), (302, [float("nan")] * 8), (303, [0.0] * 8), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    ids = np.arange(301)
    values = np.array([v for _, v in rows[:301]])
    whole = np.floor(values * 256).astype(np.int64)
    exact = exact_topk.exact_top_k(table, F.col("vec_id") % 50 == 0, 5, candidates_per_block=64, queries_per_block=2)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in exact.collect()}
    near = {(r["query_id"], r["rank"]): r["vec_id"] for r in curve_search.nearest(table, F.col("vec_id") % 50 == 0, 5).collect()}
    hits = 0
    for q in range(0, 301, 50):
        ints, reals = whole @ whole[q], values @ values[q]
        order = [i for i in np.lexsort((ids, -ints)) if i != q][:5]
        assert [got[q, r + 1] for r in range(5)] == [(i, ints[i]) for i in order]
        want = {i for i in np.lexsort((ids, -reals)) if i != q}
        hits += len({near[q, r] for r in range(1, 6)} & set([i for i in np.lexsort((ids, -reals)) if i != q][:5]))
        assert want
    assert hits >= 0.9 * 5 * 7
    assert curve_search.nearest(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_search_windows_hold_their_share_at_every_size():
    for total in [*range(1, 3000), *range(3000, 3_000_000, 997), 10**9]:
        stretch, around = curve_search.window(total)
        share = (2 * around + 1) * stretch / total
        assert stretch <= curve_search.STRETCH and share >= 2 * curve_search.REACH - 1e-12
        assert total < 3000 or share < 2.01 * curve_search.REACH


def test_hilbert_curve_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = hilbert.hilbert_index(grid, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_mixing_meets_targets(docs):
    rows = mixing.mix_report(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix_report(docs.limit(0)).count() == 0
    times = Counter(r["doc_id"] for r in mixing.mix_documents(docs).collect())
    assert {r["doc_id"]: r["taken"] for r in rows if r["taken"]} == {
        r["doc_id"]: times[r["doc_id"]] * r["size"] for r in rows if r["taken"]
    }


def test_private_data(docs, spark):
    text = "Call +1 (644) 555-8547, again 644-555-8547. Card 4111 1111 1111 1111. Mrs. Anna Miller and Mr Miller."
    table = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "")], "doc_id long, text string")
    found = by_id(private_data.replace_private_data(table, b"k"))
    made = found[1]["text"]
    assert found[2]["text"] == made and found[3]["text"] is None and found[4]["text"] == ""
    old, new = list(private_data.entities(text)), list(private_data.entities(made))
    assert [e[2] for e in old] == [e[2] for e in new] and not {e[3] for e in old} & {e[3] for e in new}
    assert new[0][3] == new[1][3] and new[-1][3] == new[-2][3]
    assert by_id(private_data.replace_private_data(docs, b"k"))[14]["n_replaced"] == 2


def test_private_data_whose_form_is_used_up(spark):
    texts = ["password=******** and token: пароль-тайна", "at 1٢.3.4.5 and ٤١١١ ١١١١ ١١١١ ١١١١", "AKIA" + "A1" * 8]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {i: r["text"] for i, r in by_id(private_data.replace_private_data(table, b"k")).items()}
    assert "********" != made[0][9:17] or len(made[0]) > len(texts[0])
    assert made[2] != texts[2] and made[2].startswith("AKIA")
    # more given names, and more addresses of a private range, than there are names or other addresses to give
    names = [("given-m-latin", f"name{i}") for i in range(300)]
    addresses = [("ip", f"192.168.{i >> 8}.{i & 255}") for i in range(0, 1 << 16, 16)]
    masked = [("secret", "*" * n) for n in range(6, 12)]
    found = spark.createDataFrame(names + addresses + masked, "kind string, value string")
    rows = private_data.assign_surrogates(found, b"k").collect()
    asked = {tuple(r) for r in found.collect()}
    assert {(r["kind"], r["value"]) for r in rows} == asked
    assert len({(r["kind"], r["made"]) for r in rows}) == len(rows) == len(asked)
    assert not {(r["kind"], r["made"]) for r in rows} & asked


def test_private_data_finds_secrets_behind_labels_of_any_spelling(spark):
    texts = [
        'TOKEN = "9233A8ECF7C5B09F"', "PASSWORD=hunter22", "Token: abc123xyz", "DB_PASSWORD=hunter22", "access_token=abc123xyz",
        '{"password": "hunter22", "x": 1}', "{'api-key':'abc123xyz'}", r'"{\"Secret\": \"abc123xyz\"}"',
    ]
    found = by_id(private_data.replace_private_data(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), b"k"))
    for i, text in enumerate(texts):
        made = found[i]["text"]
        assert found[i]["n_replaced"] == 1 and len(made) == len(text)
        assert not any(s in made for s in ("9233A8ECF7C5B09F", "hunter22", "abc123xyz"))
    assert re.fullmatch('TOKEN = "[0-9A-F]{16}"', found[0]["text"])
    assert not list(private_data.entities("tokens=100000 and tokenizer: sentences"))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("4111 1111 1111 1111 12/27", ["4111 1111 1111 1111"]),
        ("4111111111111111 123", ["4111111111111111"]),
        ("123 4111-1111-1111-1111 1", ["4111-1111-1111-1111"]),
        ("4111111111111111 159.210.220.238", ["4111111111111111", "159.210.220.238"]),
        ("1234567890 159.210.220.238", ["159.210.220.238"]),
        ("123-45-6789 555-123-4567", ["123-45-6789", "555-123-4567"]),
        ("555-123-4567 555-123-4568 555-123-4569", ["555-123-4567", "555-123-4568", "555-123-4569"]),
        ("4111 1111 1111 1111 5500 0000 0000 0004", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
        ("AB12 4111 1111 1111 1111", ["4111 1111 1111 1111"]),
        ("AT611904300234573201 2024", ["AT611904300234573201"]),
        ("4111 1111 1111 1113 " + "1 2 3 4 5 6 7 8 9 0 " * 9, []),
    ],
)
def test_private_data_finds_numbers_next_to_each_other(text, found):
    assert [text[e[0] : e[1]] for e in private_data.entities(text)] == found


def test_private_data_replaces_later_mentions_of_a_name(spark):
    text = (
        "Anna's dog. Mrs Anna Miller called. Anna said to MILLER, anna and Miller-Lee that Ann and Millers left; "
        "write to Anna@mail.example.com. Mr Miller’s car on Rodeo Dr. The car, the house, the garden and the end. The End."
    )
    found = by_id(private_data.replace_private_data(spark.createDataFrame([(1, text)], "doc_id int, text string"), b"k"))
    made = found[1]["text"]
    anna, miller = re.search(r"Mrs (\w+) (\w+) called", made).groups()
    assert (anna, miller) != ("Anna", "Miller") and found[1]["n_replaced"] == 9
    assert made.startswith(f"{anna}'s dog. Mrs {anna} {miller} called. {anna} said to {miller.upper()}, anna and {miller}-Lee")
    assert " that Ann and Millers left; " in made and f"Mr {miller}’s car" in made
    assert made.endswith(" car, the house, the garden and the end. The End.")


def test_toxicity(spark):
    clean, bad = "you are a kind friend number {}", "you are a stup1d friend number {}"
    rows = [(i, (bad if i % 2 else clean).format(chr(97 + i % 26) * (2 + i // 26))) for i in range(200)] + [(999, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(table, labels)
    found = by_id(toxicity.score_toxicity(table, lexicon))
    assert all(found[i]["predicted"] == i % 2 for i in range(200)) and found[999]["predicted"] == 0
    assert toxicity.learn_lexicon(table, labels.limit(0)).score("anything") < 0.3


def test_language(spark):
    said = {"en": "the house of the king and that is what they say", "fr": "la maison du roi et ce que nous disons dans les rues"}
    rows = [(i, said[lang], lang, "h") for i in range(40) for lang in said] + [(90, None, "en", None), (91, "123", None, "h")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = language.document_languages(table, ["doc_id", "lang"]).collect()
    assert len(found) == len(rows)
    assert all(r["language"] == r["lang"] and r["accepted"] for r in found if r["doc_id"] < 90)
    assert not any(r["accepted"] for r in found if r["doc_id"] >= 90)


def test_language_knows_every_labelled_language_and_its_spellings(spark):
    random = np.random.default_rng(5)
    codes = [f"{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(70)]
    words = {c: ["".join(w) for w in random.choice(list("abcdefghijklmnopqrstuvwxyz"), (12, 6))] for c in codes}
    rows = []
    for i, code in enumerate(codes):
        for j in range(8 if i < 64 else 6):  # the last are the rarest
            tag = [code, code.upper(), f"{code}-US", f" {code.upper()}_x", "und", None][j % 6]
            rows.append((100 * i + j, " ".join(random.choice(words[code], 40)), tag, "h"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert language.fit_text_model(table).languages == codes
    found = language.document_languages(table, ["doc_id"]).collect()
    assert len(found) == len(rows)
    assert all(r["language"] == codes[r["doc_id"] // 100] and r["accepted"] for r in found)


def test_language_tables_of_few_and_many_languages_agree(monkeypatch):
    random = np.random.default_rng(6)
    cells = np.unique(random.integers(0, language.BUCKETS * 5, 20_000))
    given = ["a", "b", "c", "d", "e"], cells % 5, cells // 5, random.integers(1, 90, len(cells))
    dense = language.TextModel(*given)
    monkeypatch.setattr(language, "DENSE", 4)
    sparse = language.TextModel(*given)
    assert dense.table is not None and sparse.table is None
    for text in (None, "", "12", "one", LONG, "Ünïcödé ñandú 東京"):
        (a, n), (b, m) = dense.likelihoods(text), sparse.likelihoods(text)
        assert n == m and np.allclose(a, b, atol=1e-4)


def test_pipeline(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = source
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, "/root/testdata/sf0.001"), name)
        if name != "encode":
            assert docs.columns == source.columns
    texts = {hashlib.sha256(t.encode()).hexdigest() for (t,) in source.select("text").collect()}
    rows = docs.collect()
    assert rows and sum(r["decoded_sha256"] in texts for r in rows) > 0.5 * len(rows)
