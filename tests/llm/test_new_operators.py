"""Ranked search, URL rules and the filter audit against plain computations on small tables."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from logweave.llm import filter_audit, queries, term_pipeline, url_filters

DOCS = "doc_id long, text string, lang string, source string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ranked search

def plain_terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def plain_ranks(docs, items, k):
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs if plain_terms(text)]
    documents, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    asked = {}
    for item_id, text in items:
        if item_id is not None:
            asked.setdefault(item_id, set()).update(plain_terms(text))
    for item_id, terms in asked.items():
        scored = []
        for doc_id, c in counts:
            m = 50 + (50 * sum(c.values()) * documents) // words
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if score > 0 and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["Été", "ß", "x1", "日本", "THE", "İ"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(n):
        return rng.choice([" ", "-", ". ", "\n", "\x1f"]).join(rng.choices(words, weights, k=n))

    docs = [(i, text(rng.randrange(1, 60))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "... ---"), (None, text(20)), (7, docs[7][1]), (503, "the THE The " * 3000)]
    docs += [(600 + i, docs[3][1]) for i in range(40)]
    items = [(i, text(rng.randrange(1, 12))) for i in range(12)] + [(3, "w1 w59"), (90, None), (91, "!!"), (None, "w1"), (92, "unseen")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 16, "bundle_items": 5}, {"block_docs": 64, "most_terms": 3}])
def test_ranked_search_equals_brute_force(spark, corpus, sizes):
    docs, items = corpus
    found = term_pipeline.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k=5, **sizes,
    )
    assert rows(found, "item_id", "rank", "doc_id", "score") == plain_ranks(docs, items, 5)


def test_ranked_search_of_nothing(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    items = spark.createDataFrame(corpus[1], "item_id long, text string")
    assert term_pipeline.rank_documents(docs.limit(0), items).count() == 0
    assert term_pipeline.rank_documents(docs, items.limit(0)).count() == 0


def test_ranked_search_with_clashing_columns(spark, corpus):
    docs, items = (
        spark.createDataFrame(given, f"{key} long, text string").withColumns(
            {c: F.lit("x") for c in ("term", "block", "bundle", "docs", "items", "weight", "score", "rank", "owner")}
        )
        for given, key in zip(corpus, ("doc_id", "item_id"))
    )
    assert rows(term_pipeline.rank_documents(docs, items, 5), "item_id", "rank", "doc_id", "score") == plain_ranks(*corpus, 5)


def test_bounds_leave_nothing_behind():
    rng = random.Random(3)
    for _ in range(200):
        first = [rng.choice([0, 0, 3, 5, 9, 20]) for _ in range(30)]
        later = [rng.randrange(0, 5) for _ in range(30)]
        import numpy as np

        scores = np.array(first)
        places = np.flatnonzero(scores)
        kept, closed = term_pipeline.keep_possible(scores[places], places, 4, 5)
        total = sorted(((-(a + b), i) for i, (a, b) in enumerate(zip(first, later)) if a + b))[:5]
        possible = set(kept.tolist()) | (set() if closed else set(range(30)) - set(places.tolist()))
        assert {i for _, i in total} <= possible


# URL rules

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("a.b", "", "block"), ("", "/x", "block"), ("twice.org", "/", "allow"), ("twice.org", "/", "block"),
]
URLS = [
    None, "", "example.net/en/", "http://Example.NET/en/1?x#y", "http://example.net/EN/1", "http://example.net",
    "http://example.net?q=/en/", "http://www.example.net#/en/", "https://notexample.net/en/", "ftp://m.example.com/de/",
    "http://example.comx/de/", "://org/fr/", "http://a.b", "http://c.a.b?z", "http://a.b.c", "x://y://net/", "http:///x",
    "http://twice.org/", "http://example.net./en/", "http://example.net:80/en/", "http://u@example.net/en/", "http://é.net/ü",
    "http://" + "a." * 500 + "net/" + "p/" * 5000,
]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, verdict) for h, p, verdict in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (h or not host)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("most_bits", [url_filters.MOST_BITS, 96])
def test_url_rules_equal_brute_force(spark, most_bits):
    rng = random.Random(5)
    hosts = ["net", "example.net", "m.example.net", "org", "de.example.com", "a.b", "q.twice.org"]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'x'])}/{i}" for i in range(300)]
    extra = [(f"h{i}.org", f"/{i % 7}", rng.choice(["allow", "block"])) for i in range(60)]
    urls += [f"http://s.h{i % 90}.org/{i % 9}/" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = RULES + extra
    frame = spark.createDataFrame([*rules, (None, "/", "block"), ("net", None, "block")], "host string, path string, verdict string")
    judged = url_filters.judge_urls(pages, frame, most_bits=most_bits)
    want = sorted(((i, *plain_verdict(u, rules)) for i, u in enumerate(urls)), key=repr)
    assert rows(judged, "page_id", "host", "path", "rule", "verdict") == want


def test_url_rules_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://net/"), (1, "http://net/"), (None, "http://x.net/a")], "page_id long, url string")
    rules = spark.sql(queries.URL_RULES)
    plain = rows(url_filters.judge_urls(pages, rules), "page_id", "rule", "verdict")
    assert plain == sorted([(1, "net/", "block")] * 2 + [(None, "net/", "block")], key=repr)
    names = ["host", "rule", "verdict", "key", "labels", "chars", "at", "best", "found", "word"]
    wide = pages.withColumns({c: F.lit(1) for c in names})
    assert rows(url_filters.judge_urls(wide, rules), "page_id", "rule", "verdict") == plain
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0
    assert rows(url_filters.judge_urls(pages, rules.limit(0)), "verdict") == [("allow",)] * 3


def test_cascade_is_exact_for_its_universe(spark):
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 60_000).select(F.concat(F.lit("k"), F.col("id") % 30_000).alias("key"))
    levels = url_filters.cascade(listed, universe, 2_000)  # a first level far too small, so that more follow
    assert len(levels) > 2
    wrong = universe.select(
        "key", url_filters.is_listed(levels, F.col("key")).alias("says"),
    ).join(listed.withColumn("is", F.lit(True)), "key", "left").filter(F.col("says") != F.coalesce("is", F.lit(False)))
    assert wrong.count() == 0
    plan = universe.select(url_filters.is_listed(levels, F.col("key")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


# filter audit

def plain_audit(docs, labels):
    least, good, toxic = {}, set(), set()
    for doc_id, text, _, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, quality, bad in labels:
        good |= {doc_id} if quality == 1 else set()
        toxic |= {doc_id} if bad == 1 else set()
    parts = {}
    for doc_id, text, lang, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * (doc_id is not None and doc_id > least[text])
        named = doc_id is not None
        parts.setdefault(lang or "", []).append((fails, named and doc_id in good, named and doc_id in toxic))
    out = []
    for part, found in parts.items():
        shapley, each = Counter(), []
        for order in permutations("ABCDE"):
            left = found
            for step, own in enumerate(order, 1):
                gone = [x for x in left if own in x[0]]
                left = [x for x in left if own not in x[0]]
                shapley[own] += len(gone)
                each.append((part, "".join(order), step, len(left), len(gone),
                             sum(own in x[0] for x in found) - len(gone), sum(x[0] == own for x in found),
                             sum(x[1] for x in gone), sum(x[2] for x in gone), own))
        out += [(*x[:-1], shapley[x[-1]]) for x in each]
    return sorted(out, key=repr)


COLUMNS = [field.split()[0] for field in filter_audit.AUDIT_SCHEMA.split(", ")]


def test_audit_equals_filtering_in_every_order(spark):
    rng = random.Random(11)
    texts = ["", None, "A B C", "plain words here", "x " * 250, "many $ " * 90, "Ü" * 40 + "AB",
             " ".join(f"w{i}" for i in range(220)), " ".join(f"W{i}#" for i in range(220)), "a\u00a0b\x1cc"]
    docs = [(rng.choice([None, *range(90)]), rng.choice(texts), rng.choice(["en", "de", "", None]), "s") for _ in range(400)]
    docs += [(1000, "long " * 60_000, "fr", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(5, 1, 1), (None, 1, 1)]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit(docs, labels)
    audit = filter_audit.audit_orders(filter_audit.contingency(*frames))
    assert rows(audit, *COLUMNS) == want
    names = ["part", "digest", "code", "n", "good", "salt", "first", "least", "cell", "half"]
    wide = [f.withColumns({c: F.lit("x") for c in names}) for f in frames]
    assert rows(filter_audit.audit_orders(filter_audit.contingency(*wide)), *COLUMNS) == want


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_orders(filter_audit.contingency(docs.limit(0), labels)).count() == 0
    audit = filter_audit.audit_orders(filter_audit.contingency(docs, labels.limit(0)))
    assert audit.count() == 600 and audit.agg(F.sum("good_lost")).first()[0] == 0
