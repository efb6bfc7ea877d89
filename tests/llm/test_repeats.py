"""Rows that repeat, components beyond 64 bits, and pieces of any length."""

import time
from random import Random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from logweave.llm import byte_bpe, curve_search, exact_topk, suffix_dedup


def asked(search, table, k):
    return [tuple(r) for r in search(table, F.col("vec_id") % 7 == 0, k).orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("search", [exact_topk.exact_top_k, curve_search.nearest])
def test_repeated_rows_change_no_result(spark, search):
    random = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(random.standard_normal((40, 4)).tolist())]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    repeated = spark.createDataFrame(rows + rows[:9] * 3 + rows[20:], once.schema)
    found = asked(search, once, 5)
    assert len(found) == 6 * 5 and asked(search, repeated, 5) == found
    values = np.array([v for _, v in rows])
    for q in range(0, 40, 7):
        whole = np.floor(values * 256).astype(np.int64) if search is exact_topk.exact_top_k else values
        scores = whole @ whole[q]
        order = [int(i) for i in np.lexsort((np.arange(40), -scores)) if i != q][:5]
        assert [r[2] for r in found if r[0] == q] == order


def test_an_id_with_several_vectors_counts_by_its_best_pair(spark):
    random = Random(3)
    rows = [(random.randrange(12), [random.uniform(-2, 2) for _ in range(3)]) for _ in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    best = {}
    for q, a in rows:
        for c, b in rows:
            if q % 7 == 0 and q != c:
                score = sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=True))
                best[q, c] = max(score, best.get((q, c), score))
    want = []
    for q in sorted({q for q, _ in best}):
        order = sorted((-s, c) for (a, c), s in best.items() if a == q)[:4]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(order)]
    assert asked(lambda *a: exact_topk.exact_top_k(*a, candidates_per_block=5, queries_per_block=1), table, 4) == want
    near = asked(curve_search.nearest, table, 4)
    assert len({(r[0], r[2]) for r in near}) == len(near) and all(r[0] != r[2] for r in near)


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1e20, 1.0]), (1, [1e20, 0.0]), (2, [-1e20, 0.0]), (3, [2.0**40, 0.0]), (4, [0.0, 1.0]), (5, [1e20, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top, low = 2**63 - 1, -(2**63)
    # terms end at 64 bits, sums are exact, and only what comes out is cut to 64 bits
    assert asked(exact_topk.exact_top_k, table, 5) == [
        (0, 1, 1, top), (0, 2, 3, top), (0, 3, 5, top), (0, 4, 4, 65_536), (0, 5, 2, low),
    ]
    # just within 64 bits: exact
    near = spark.createDataFrame([(0, [2.0**22] * 2), (1, [2.0**22, 0.5]), (2, [2.0**22, 0.25])], table.schema)
    assert asked(exact_topk.exact_top_k, near, 5) == [(0, 1, 1, 2**60 + 2**37), (0, 2, 2, 2**60 + 2**36)]


def test_small_tables_are_scored_by_all_cores(spark):
    table = spark.range(60_000).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    found = exact_topk.exact_top_k(table, F.col("vec_id") % 5000 == 0, 5)
    assert found.count() == 12 * 5
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


def test_long_pieces_equal_the_library():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = byte_bpe.load_encoder(path, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.whole, special_tokens={})
    random = Random(1)
    letters = ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "aab", "etaoinshrdlu", "абвгдежз", "日本語中文字"]
    texts = []
    for n in [513, 514, 1023, 4096, 100_000, *(int(2 ** random.uniform(9, 15)) for _ in range(60))]:
        text = "".join(random.choices(random.choice(letters), k=n))
        texts.append(text if random.random() < 0.7 else (text[: random.randint(1, 30)] * n)[:n])
    for text, ids in zip(texts, encoder.encode_block(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()
        piece = text.encode()[:700]  # the same rule in a matrix and in a heap
        assert encoder.merge_long(piece).tolist() == encoder.merge_rows([piece])[0].tolist()
    begin = time.time()
    million = "".join(random.choices(letters[0], k=1_000_000))
    assert encoder.decode(encoder.encode_block([million])[0]) == million.encode()
    assert time.time() - begin < 30


def test_rows_that_repeat_id_and_text(spark):
    random = Random(2)
    text = " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(150))
    other = "x" * 7 + text[300:700] + "y" * 9
    near = text[:400] + "z" + text[400:]
    rows = [(None, text)] * 5000 + [(7, text)] * 3 + [(8, other), (9, near), (10, "short")] + [(10, "short")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs, 200).select("doc_id", "n_bytes", "spans", "kept").collect()
    assert len(found) == len(rows)
    kept = {}
    for r in found:
        kept.setdefault(r["doc_id"], []).append((bytes(r["kept"]).decode(), [tuple(s) for s in r["spans"]]))
    assert kept[None] == [("", [(0, len(text))])] * 5000 and kept[7] == [("", [(0, len(text))])] * 3
    assert kept[8] == [("x" * 7 + "y" * 9, [(7, 407)])]
    assert kept[9] == [("z", [(0, 400), (401, len(near))])]
    assert kept[10] == [("short", [])] * 51
    # a text that only repeats its own row goes wholly too
    alone = spark.createDataFrame([(1, near)] * 2 + [(2, other[:150])], docs.schema)
    assert sorted((r["doc_id"], len(r["kept"])) for r in suffix_dedup.remove_repeats(alone, 200).collect()) == [(1, 0), (1, 0), (2, 150)]
