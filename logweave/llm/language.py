"""Language of texts from the text, the declared language, the address suffix and the host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import text_blocks
from logweave.session import materialize

# documents per language that the text model is fitted on
SAMPLE = 400
# languages up to which the table of triples holds every number
DENSE = 64
# tags that name no language
UNKNOWN = ["", "und", "mis", "mul", "zxx"]
BUCKETS = 1 << 14
# letter triples that a text counts for at most: neighbouring triples are far from independent
EFFECTIVE = 50
# observations that a host's own counts are smoothed with
PULL = 20.0
CONFIDENCE = 0.5

_letters = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


def triples(text: str) -> tuple[np.ndarray, int]:
    """Hashed byte triples of the lower-case text, and how many bytes are letters."""
    data = np.frombuffer((" " + text.lower() + " ").encode().translate(_letters), np.uint8).astype(np.uint32)
    hashed = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
    inside = (data[1:-1] != 32)
    return (hashed >> np.uint32(18)).astype(np.int64)[inside], int((data != 32).sum())


def primary_language(tag: Column) -> Column:
    """The primary subtag in lower case; null for none and for tags that name no language."""
    primary = F.lower(F.regexp_extract(tag, r"^\s*([^-_\s]*)", 1))
    return F.when(~primary.isin(UNKNOWN), primary)


class TextModel:
    """Log probability of letter triples in each language.

    Made of the numbers seen, for buckets in ascending order. All others count ``UNSEEN``, so that for many languages
    only what a triple seen adds to the logarithm is kept.
    """

    UNSEEN = 0.1

    def __init__(self, languages: list[str], lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.languages = languages
        totals = self.UNSEEN * BUCKETS + np.bincount(lang, weights=n, minlength=len(languages))
        self.table = None
        if len(languages) <= DENSE:
            table = np.full((BUCKETS, len(languages)), self.UNSEEN)
            table[bucket, lang] += n
            self.table = np.log(table / totals)
        else:
            self.base = np.log(self.UNSEEN / totals)
            self.first = np.searchsorted(bucket, np.arange(BUCKETS + 1))
            self.lang, self.more = lang.astype(np.int32), np.log1p(n / self.UNSEEN).astype(np.float32)

    def _mean(self, found: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[found].mean(axis=0)
        buckets, times = np.unique(found, return_counts=True)
        sizes = self.first[buckets + 1] - self.first[buckets]
        places = np.repeat(self.first[buckets] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        weights = self.more[places] * np.repeat(times, sizes)
        return self.base + np.bincount(self.lang[places], weights=weights, minlength=len(self.languages)) / len(found)

    def likelihoods(self, text: str | None) -> tuple[list[float], int]:
        """Log likelihood of the text in each language, damped, and its number of letter bytes."""
        found, letters = triples(text or "")
        if not letters or not len(found):
            return [0.0] * len(self.languages), 0
        return (self._mean(found) * min(len(found), EFFECTIVE)).tolist(), letters


def fit_text_model(labelled: DataFrame, sample: int = SAMPLE) -> TextModel:
    """A model from ``text, lang``; rows without either are passed over, and those whose tag names no language.

    Knows every language that has labelled rows, by its primary subtag, and takes of each the ``sample`` texts with the
    smallest hashes; a repeated text is one. What comes to the driver is a few numbers per language, and one per
    language and triple bucket seen. The number of languages has no limit.
    """
    rows = labelled.filter("text is not null").select("text", primary_language(F.col("lang")).alias("lang"))
    rows = rows.filter("lang is not null").withColumn("hash", F.xxhash64("text"))

    def within(limits: dict[str, int]) -> DataFrame:
        # a local relation, whose size Spark knows
        table = pa.table({"lang": pa.array(list(limits), pa.string()), "most": pa.array(list(limits.values()), pa.int64())})
        return rows.join(rows.sparkSession.createDataFrame(table), "lang").filter("hash <= most")

    # hashes are spread evenly, so that twice the share asked has enough texts, and not many more
    texts = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()
    shares = {r["lang"]: min(1.0, 2 * (sample + 10) / max(1, r["n"])) for r in texts}
    low = within({lang: int(share * (1 << 64)) - (1 << 63) - (share == 1) for lang, share in shares.items()})
    smallest = F.slice(F.sort_array(F.collect_set("hash")), 1, sample)
    last = {r["lang"]: r["last"] for r in low.groupBy("lang").agg(F.array_max(smallest).alias("last")).collect()}
    languages = sorted(last)
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            cells = [np.empty(0, np.int64)]
            for text, lang in zip(block.column("text").to_pylist(), block.column("lang").to_pylist(), strict=True):
                cells.append(triples(text)[0] + place[lang] * BUCKETS)
            cell, n = np.unique(np.concatenate(cells), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell // BUCKETS), pa.array(cell % BUCKETS), pa.array(n)], ["lang", "bucket", "n"]
            )

    chosen = within(last).groupBy("lang", "hash").agg(F.min("text").alias("text")).select("text", "lang")
    sums = chosen.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    lang, bucket, n = (found.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    order = np.lexsort((lang, bucket))
    return TextModel(languages, lang[order], bucket[order], n[order])


def _by_language(counts: DataFrame, *keys: str) -> DataFrame:
    """Per key the number of rows as ``all`` and a map from languages to theirs as ``m``."""
    return counts.groupBy(*keys).agg(
        F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m")
    )


def _logs(counts: DataFrame, key: str, smooth: float, languages: int) -> DataFrame:
    """Per key an array: smoothed log share of the key in each language."""
    keys = counts.select(key).distinct().count()
    all_of = {r["best"]: r["n"] for r in counts.groupBy("best").agg(F.sum("n").alias("n")).collect()}  # a number per language
    below = F.lit([all_of.get(i, 0) + smooth * (keys + 1) for i in range(languages)])
    share = F.transform(below, lambda x, i: F.log((F.coalesce(F.col("m")[i], F.lit(0)) + smooth) / x))
    return _by_language(counts, key).select(key, share.alias(f"{key}_log"))


def identify_language(
    rows: DataFrame,
    model: TextModel,
    declared: Column,
    suffix: Column,
    host: Column,
    keep: list[str],
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The columns ``keep`` with ``language, confidence, accepted`` for every row of ``rows`` (column ``text``).

    Four kinds of evidence are added as log probabilities: the text under the model; the declared language and the
    address suffix given the language; and the language given the host. The last three are
    estimated from counts over all rows of what the text alone says: those of the declaration and the suffix
    smoothed by one half, a host's smoothed by its domain's, these by those of all rows. A missing
    declaration (or one that names no language), suffix or host is a value of its own. Ties go to the first language.

    A row is accepted if the best language has this probability. A null or empty text, or one
    without letters, has no language, confidence 0, and is not accepted. Repeated rows and null ids count
    like any; without known languages nothing is accepted.
    """
    names = model.languages
    if not names:
        return rows.select(
            *keep, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted")
        )
    held = rows.select(
        *[F.col(c).alias(f"k_{c}") for c in keep],
        "text",
        F.coalesce(primary_language(declared), F.lit("")).alias("declared"),
        F.coalesce(F.lower(suffix), F.lit("")).alias("suffix"),
        F.coalesce(F.lower(host), F.lit("")).alias("host"),
    )
    plain = [c for c in held.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found = [model.likelihoods(text) for text in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[block.column(c) for c in plain],
                    pa.array([f[0] for f in found], pa.list_(pa.float64())),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([int(np.argmax(f[0])) for f in found], pa.int32()),
                ],
                [*plain, "text_log", "letters", "best"],
            )

    read = materialize(
        held.mapInArrow(run, f"{schema}, text_log array<double>, letters long, best int"), "text-likelihoods"
    )
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    read = read.withColumn("domain", F.when(domain == "", F.col("host")).otherwise(domain))
    seen = read.filter("letters > 0")
    count = F.count(F.lit(1)).alias("n")
    declared_log = _logs(seen.groupBy("declared", "best").agg(count), "declared", 0.5, len(names))
    suffix_log = _logs(seen.groupBy("suffix", "best").agg(count), "suffix", 0.5, len(names))

    # shares of languages: of all rows, of a domain, of a host
    everywhere = {r["best"]: r["n"] for r in seen.groupBy("best").agg(count).collect()}
    total = sum(everywhere.values())
    base = [(everywhere.get(i, 0) + 1) / (total + len(names)) for i in range(len(names))]
    by_host = materialize(seen.groupBy("domain", "host", "best").agg(count), "host-counts")
    pulled = F.lit([PULL * share for share in base])

    def share(pull: Column) -> Column:
        return F.transform(pull, lambda x, i: (F.coalesce(F.col("m")[i], F.lit(0)) + x) / (F.col("all") + PULL))

    of_domain = _by_language(by_host.groupBy("domain", "best").agg(F.sum("n").alias("n")), "domain")
    domains = of_domain.select("domain", F.transform(share(pulled), lambda x: PULL * x).alias("up"))
    hosts = _by_language(by_host, "domain", "host").join(domains, "domain")
    hosts = hosts.select("host", F.transform(share(F.col("up")), lambda x: F.log(x)).alias("host_log"))
    joined = read.join(declared_log, "declared", "left").join(suffix_log, "suffix", "left").join(hosts, "host", "left")
    nothing = F.lit(0.0)
    fused = F.transform(
        "text_log",
        lambda x, i: x
        + F.coalesce(F.col("declared_log")[i], nothing)
        + F.coalesce(F.col("suffix_log")[i], nothing)
        + F.coalesce(F.col("host_log")[i], nothing),
    )
    scored = joined.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    chance = 1 / F.aggregate("fused", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    known = F.col("letters") > 0
    best = F.lit(names)[(F.array_position("fused", F.col("top")) - 1).cast("int")]
    return scored.select(
        *[F.col(f"k_{c}").alias(c) for c in keep],
        F.when(known, best).alias("language"),
        F.when(known, chance).otherwise(nothing).alias("confidence"),
        (known & (chance >= confidence)).alias("accepted"),
    )


def document_languages(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Languages of documents ``text, lang, source``: declared by ``lang``, with the source as host."""
    model = fit_text_model(docs)
    return identify_language(docs, model, F.col("lang"), F.lit(None).cast("string"), F.col("source"), keep)


def page_languages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Languages of pages ``page_id, url, html``, from the visible text, the markup, the address and the host."""
    hidden = r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>"
    host = F.regexp_extract("url", r"^\w+://([^/:?#]+)", 1)
    rows = pages.select(
        "page_id",
        F.regexp_replace("html", hidden, " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z]{2,3})", 1).alias("markup"),
        host.alias("address"),
    )
    suffix = F.regexp_extract("address", r"\.([^.]+)$", 1)
    return identify_language(rows, model, F.col("markup"), suffix, F.col("address"), ["page_id"])
