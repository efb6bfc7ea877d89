"""URL rules by cascades of Bloom filters, exact for all keys of the corpus; DataFrame functions only."""

from __future__ import annotations

import math
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.blocks import unused
from logweave.session import materialize

VERDICTS = ("block", "allow")
# Bits of all filters of a cascade that a plan may carry (32 MB); longer lists are cut into slices.
MOST_BITS = 1 << 28
# False positives of every level behind the first
LATER_RATE = 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL; both are empty without ``://``, also for null."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1))
    rest = F.when(rest.isNotNull(), F.substr(url, F.length(rest) + 4))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


@dataclass(frozen=True)
class Bloom:
    """Bits in words of 64, as text so that a plan carries one literal; ``level`` seeds the hashes."""

    level: int
    hashes: int
    bits: int
    words: str

    def holds(self, key: Column) -> Column:
        """Whether the key may be in; ``And`` stops at the first bit that is not set."""
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded into one array by the optimizer
        return reduce(
            Column.__and__,
            [
                F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1
                for at in places(key, self.level, self.hashes, self.bits)
            ],
        )


def places(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    """Bits of a key at a level; the seed comes first, so that keys equal in one hash differ in the next."""
    return [F.pmod(F.xxhash64(F.lit(level << 8 | i), key), F.lit(bits)) for i in range(hashes)]


def filter_shape(keys: int, rate: float) -> tuple[int, int]:
    """Hashes and bits of a filter for so many keys with so many false positives."""
    hashes = max(1, round(-math.log2(rate)))
    return hashes, 64 * max(1, math.ceil(keys * -math.log2(rate) / math.log(2) / 64))


def first_rate(listed: int, universe: int) -> float:
    """False positives of the first level, with which it and the next ones take fewest bits in all."""
    return min(LATER_RATE, math.sqrt(0.5) * max(listed, 1) / max(universe, 1))


def fill(keys: DataFrame, level: int, rate: float) -> Bloom | None:
    """The filter of a level; none for no keys. Its words, not the keys, come to the driver."""
    count = keys.count()
    if not count:
        return None
    hashes, bits = filter_shape(count, rate)
    at = keys.select(F.explode(F.array(*places(F.col("key"), level, hashes, bits))).alias("at"))
    one = F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(one.alias("bits")).collect()
    found = {row["word"]: row["bits"] for row in words}
    return Bloom(level, hashes, bits, ",".join(str(found.get(i, 0)) for i in range(bits // 64)))


def cascade(listed: DataFrame, universe: DataFrame, distinct: int) -> list[Bloom]:
    """Filters that tell for every ``key`` of ``listed`` or ``universe`` whether it is listed.

    The first level holds the listed keys. Every next level holds the keys of the other kind that all levels so far
    let through: false positives of the universe, then listed keys among those, and so on until none are left.
    ``universe`` may repeat keys; ``distinct`` says about how many it has and only decides sizes. Of the
    universe only what the first level lets through is gathered.
    """
    own = materialize(listed.select("key").distinct(), "listed-keys")
    first = fill(own, 0, first_rate(own.count(), distinct))
    if first is None:
        return []
    passed = universe.filter(first.holds(F.col("key"))).select("key").distinct()
    other = materialize(passed.join(own, "key", "left_anti"), "false-positives")
    levels, kinds = [first], (own, other)
    while True:
        level = len(levels)
        kind = kinds[level % 2]
        # all levels that hold the other kind have let this key through so far
        asked = [x.holds(F.col("key")) for x in levels if x.level % 2 != level % 2]
        found = fill(kind.filter(reduce(Column.__and__, asked)), level, LATER_RATE)
        if found is None:
            return levels
        levels.append(found)


def is_listed(levels: list[Bloom], key: Column) -> Column:
    """Whether a key of the cascade's universe is listed: the first level without it decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for bloom in reversed(levels):
        answer = F.when(~bloom.holds(key), F.lit(bloom.level % 2 == 1)).otherwise(answer)
    return answer


def rule_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys under which a rule for this URL could be listed: for every shape (number of the host's last labels, length of
    the path's beginning) the text of both, null where the URL is shorter."""
    wanted = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes])
    labels = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1

    def key(shape: Column) -> Column:
        end = F.call_function("substring_index", host, F.lit("."), -shape["labels"])
        fits = (labels >= shape["labels"]) & (F.length(path) >= shape["chars"])
        return F.when(fits, F.concat(end, F.substr(path, F.lit(1), shape["chars"])))

    return F.filter(F.transform(wanted, key), lambda k: k.isNotNull())


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", unlisted: str = "allow", most_bits: int = MOST_BITS
) -> DataFrame:
    """All rows of ``pages`` with ``host, path, rule, verdict``; see ``url_parts``.

    ``rules`` has ``host``, in lower case, ``path`` and ``verdict`` (``block`` or ``allow``). A rule fits its host and
    all subdomains where the path starts with the rule's. The longest rule wins, as text of host and path; of equally
    long ones the greater text, and ``block`` if a rule is listed with both verdicts. ``rule`` is that text, null where no rule
    fits; such a URL has no listed key, and its verdict is ``unlisted``. Rules with null in a column are passed over.
    A null URL has an empty host and path. Result columns replace columns of these names.

    A URL has one key for every shape that rules have. Two cascades, of blocked and of allowed keys, decide exactly
    which of the keys are rules, so no page is joined or moved. Their bits follow the length of the list; one that
    needs over ``most_bits`` is cut into slices by a hash of the key, with a pass over the pages for each.
    """
    rules = materialize(rules.select("host", "path", "verdict").dropna(), "rules")
    labels = F.length("host") - F.length(F.replace("host", F.lit("."))) + 1
    shapes = rules.select(labels.alias("labels"), F.length("path").alias("chars")).distinct().collect()
    shapes = sorted((row["labels"], row["chars"]) for row in shapes)
    host, path = url_parts(F.col(url_col))
    rest = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    out = pages.select(*rest, host.alias("host"), path.alias("path"))
    best = F.lit(None).cast("struct<chars:int,rule:string,verdict:string>")
    if not shapes:
        return out.select(*rest, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict"))
    keyed = rules.select(F.concat("host", "path").alias("key"), "verdict").distinct()
    candidates = rule_keys(F.col("host"), F.col("path"), shapes)
    keys = out.select(F.explode(candidates).alias("key"))
    distinct = keys.agg(F.approx_count_distinct("key")).first()[0]
    passes = 0
    for verdict in VERDICTS:
        listed = keyed.filter(F.col("verdict") == verdict).select("key")
        count = listed.count()
        slices = -(-2 * filter_shape(count, first_rate(count, distinct))[1] // most_bits)
        for number in range(slices if count else 0):
            here = F.pmod(F.xxhash64(F.lit("slice"), F.col("key")), F.lit(slices)) == number
            levels = cascade(listed.filter(here), keys.filter(here), distinct // slices + 1)
            if not levels:
                continue
            best, passes = F.greatest(best, longest_listed(candidates, levels, verdict, number, slices)), passes + 1
            if passes > len(VERDICTS):  # a plan carries the filters of two slices at most
                taken = best.alias(unused(out, "best"))
                out = materialize(out.select(*rest, "host", "path", taken), "judged-urls")
                best, passes = F.col(out.columns[-1]), 1
    return out.select(
        *rest, "host", "path", best["rule"].alias("rule"), F.coalesce(best["verdict"], F.lit(unlisted)).alias("verdict")
    )


def longest_listed(keys: Column, levels: list[Bloom], verdict: str, number: int, slices: int) -> Column:
    """``chars, rule, verdict`` of the longest of a URL's keys that a slice of the list has; null for none."""

    def in_list(key: Column) -> Column:
        return (F.pmod(F.xxhash64(F.lit("slice"), key), F.lit(slices)) == number) & is_listed(levels, key)

    def entry(key: Column) -> Column:
        return F.struct(F.length(key).alias("chars"), key.alias("rule"), F.lit(verdict).alias("verdict"))

    return F.array_max(F.transform(F.filter(keys, in_list), entry))


# Every rule against every URL.
URL_SQL = """
WITH rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), cut AS (
    SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, row_number() OVER () AS row,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), fitting AS (
    SELECT p.row, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.row ORDER BY length(r.host || r.path) DESC) AS nth
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON p.row = f.row AND f.nth = 1
"""
