"""Rows that share an id, names that operators use, and scratch tables of the pipeline."""

from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import mixing, near_dedup, private_data
from logweave.session import kept_table, work_dir

SCHEMA = "doc_id long, text string, lang string, source string"


def words(seed, n=60):
    return " ".join(f"w{(seed * 7919 + i * i * 31) % 100_003}" for i in range(n))


def test_different_texts_of_one_id_all_stay(spark):
    rows = [(1, words(i), "en", "a") for i in range(30)]
    rows += [(1, words(3), "en", "a"), (2, words(3), "en", "a"), (2, words(99), "en", "b"), (3, words(99) + " more", "en", "b")]
    rows += [(None, words(5), "en", "a"), (None, words(5), "en", "a"), (4, None, "en", "a"), (4, "", "en", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    want = [(1, words(i)) for i in range(30)] + [(2, words(99)), (None, words(5)), (None, words(5)), (4, None)]
    assert found == sorted(want, key=repr)  # a null text is an empty one, so id 4 is one document


def test_components_equal_brute_force(spark):
    """Links of at least 80 % by five-word shingles, with copies, near copies and repeated ids."""
    base = [words(i, 80).split() for i in range(12)]
    rows = []
    for n in range(120):
        text = list(base[n % 12])
        for place in range(n % 5):
            text[(place * 17 + n) % len(text)] = f"x{n}"
        rows.append((n % 100, " ".join(text), "en", "a"))
    sets = [frozenset(tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)) for _, t, _, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        least[root(i)] = min(row[0], least.get(root(i), row[0]))
    want = sorted((row[0], len(sets[i]), least[root(i)]) for i, row in enumerate(rows))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), 5, 0.8)
    assert sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()) == want


def test_private_data_beside_columns_of_any_name_and_type(spark):
    docs = spark.createDataFrame([(1, "mail a.b@example.com", "en", "a"), (1, "mail a.b@example.com now", "en", "a")], SCHEMA)
    plain = sorted(r["text"] for r in private_data.replace_private_data(docs, b"k").collect())
    wide = docs.withColumns(
        {"_check": F.lit(1), "check": F.lit("x"), "made_for": F.lit(2), "value": F.create_map(F.lit("a"), F.lit(1)), "made": F.lit(0)}
    )
    out = private_data.replace_private_data(wide, b"k", count=None)
    assert out.columns == wide.columns
    assert sorted(r["text"] for r in out.collect()) == plain and "example.com" not in plain[0]


def test_mix_takes_what_the_report_says(spark):
    rows = [(i % 40 if i % 9 else None, "w " * (i % 13), "en", [None, "", "a", "b", "c"][i % 5]) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("_words", "_copy", "row", "place", "none", "last", "key")})
    report = mixing.mix_report(docs.drop("row", "key"))
    want = {}
    for r in report.collect():
        if r["size"]:
            want[r["doc_id"], r["source"], r["size"]] = want.get((r["doc_id"], r["source"], r["size"]), 0) + r["taken"] // r["size"]
    for most in (100_000, 1):
        mixed = mixing.mix_documents(docs, most_sources=most)
        assert mixed.columns == docs.columns
        got = {}
        for r in mixed.collect():
            place = r["doc_id"], r["source"], len(r["text"].split())
            got[place] = got.get(place, 0) + 1
        assert got == {k: v for k, v in want.items() if v}


def test_scratch_of_a_stage_goes_with_it(spark):
    here = Path(work_dir(spark, "x")).parent
    before = set(here.iterdir()) if here.exists() else set()
    rows = [(i, words(i) + f" call 644-555-{8000 + i}", "en", f"s{i % 3}") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = kept_table(spark, "stage", lambda given=docs, f=stage: f(spark, given, ""))
        assert docs.count() > 0
        before |= {next(iter(set(here.iterdir()) - before))}
        assert set(here.iterdir()) == before
