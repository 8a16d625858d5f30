"""URL filters: host and path rules, then exact list membership by a cascade of Bloom filters.

A list is a table of keys: hosts, each with all its subdomains, and directories (a host and the first part of a path). The universe is all keys that the urls of a
corpus have and that a list can hold: their hosts and the domains above these, of as many labels as some listed host has, and their directories. So a host of
any length takes as many tests as the list has numbers of labels, not as many as it has labels itself.

The cascade's first level encodes the listed keys. Over the complete universe, the second
encodes the first's false positives, the third those listed keys that the second wrongly holds, and so
on until a level has no false positive. A key is listed if the number of levels that hold it, up to
the first that doesn't, is odd. Every level is a constant of the plan, so judging a row takes no join.

A long list is cut into shards of about SHARD_KEYS keys by a hash of the key, each with a cascade of its own, built together level by level. A plan holds the constants of
up to SHARDS_AT_ONCE of them; for a longer list the rows are read in as many passes as that takes, each of which adds what its shards
list, so no size of a list leads to a join.

Edge cases: a null url, or one without "://", has an empty host and path and fits no rule; an empty host is
a key like any other. Repeated urls get the same verdict each. An empty table gives an empty
table. Other columns of the input are ignored. Keys outside the universe may be judged wrongly, as in
any Bloom filter, so the universe must hold the keys of all rows to be judged. Null keys of a list are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import LOWER, UPPER, free_name, settle

#: The production rules, verdict first.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Terms that put a host on the default list if one of its hyphenated labels is one of them, and parameters that mark a url as a campaign's.
BLOCKED_TERMS = ("adult", "ads", "bets", "casino", "pills", "spam")
CAMPAIGN = r"[?&](?:utm_[a-z]+|ref|aff|affid|clickid|gclid|fbclid)="
#: A directory is on the default list if it has so many urls at least and more than half of them are a campaign's.
LEAST_URLS = 3
SHARD_KEYS = 500_000  #: 0.6 MB of bits at the default rate
SHARDS_AT_ONCE = 16
CHUNK_WORDS = 256  #: words of a filter that come as one value
FALSE_POSITIVES = 0.01
WORD_BITS = 32


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def directory_of(host: Column, path: Column) -> Column:
    """The host and the first part of the path, if the path has further parts."""
    return F.concat(host, F.regexp_extract(path, r"^(?:/[^/]*/)?", 0))


def labels_of(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def domains_of(host: Column, counts: Sequence[int]) -> Column:
    """The host and the domains above it that have so many labels as counts says; no others can be on a list of such keys."""
    if not counts:
        return F.array().cast("array<string>")
    fitting = F.filter(F.array(*map(F.lit, counts)), lambda n: n <= labels_of(host))
    return F.transform(fitting, lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def label_counts(listed: DataFrame) -> list[int]:
    """How many labels the listed hosts have: as many numbers as there are different ones."""
    hosts = listed.filter(~F.col("key").contains("/"))
    return sorted(r.n for r in hosts.select(labels_of(F.col("key")).alias("n")).distinct().collect())


class Level:
    """One Bloom filter as a constant expression."""

    def __init__(self, number: int, bits: int, hashes: int, chunks: dict[int, bytes]):
        self.number, self.bits, self.hashes = number, bits, hashes
        empty = bytes(CHUNK_WORDS * WORD_BITS // 8)
        self.data = b"".join(chunks.get(i, empty) for i in range(bits // (WORD_BITS * CHUNK_WORDS)))

    def holds(self, key: Column) -> Column:
        out = F.lit(True)
        data = F.lit(bytearray(self.data))
        for at in positions(key, self.number, self.bits, self.hashes):
            start = (F.floor(at / WORD_BITS) * (WORD_BITS // 8) + 1).cast("int")
            word = F.conv(F.hex(F.substring(data, start, F.lit(WORD_BITS // 8))), 16, 10).cast("long")
            out = out & (F.getbit(word, (at % WORD_BITS).cast("int")) == 1)
        return out


def positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(j)), F.lit(bits)) for j in range(hashes)]


def size_for(keys: int, rate: float) -> tuple[int, int]:
    """Bits (a multiple of a chunk) and number of hash functions."""
    bits = max(64, math.ceil(keys * math.log(1 / rate) / math.log(2) ** 2))
    hashes = max(1, round(bits / max(keys, 1) * math.log(2)))
    chunk = WORD_BITS * CHUNK_WORDS
    return -(-bits // chunk) * chunk, min(hashes, 7)


def filter_chunks(keys: DataFrame, number: int, sizes: dict[int, tuple[int, int]]) -> dict[int, dict[int, bytes]]:
    """By shard, the filter's bits by chunk, from rows (key, shard). sizes: bits and hash functions of each shard.

    One aggregation for all shards: words are summed up as a partially aggregated bitwise or, and put together natively.
    """
    at = F.array().cast("array<long>")
    for s, (bits, hashes) in sizes.items():
        at = F.when(F.col("shard") == s, F.array(*positions(F.col("key"), number, bits, hashes))).otherwise(at)
    word = F.floor(F.col("at") / WORD_BITS).alias("word")
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % WORD_BITS).cast("int"))).alias("mask")
    words = keys.select("shard", F.explode(at).alias("at")).groupBy("shard", word).agg(mask)
    held = F.map_from_entries(F.collect_list(F.struct((F.col("word") % CHUNK_WORDS).cast("int"), "mask")))  # CHUNK_WORDS at most
    chunks = words.groupBy("shard", F.floor(F.col("word") / CHUNK_WORDS).alias("chunk")).agg(held.alias("m"))
    digits = F.transform(F.sequence(F.lit(0), F.lit(CHUNK_WORDS - 1)), lambda i: F.lpad(F.hex(F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0).cast("long"))), WORD_BITS // 4, "0"))
    rows = chunks.select("shard", "chunk", F.unhex(F.array_join(digits, "")).alias("bytes")).collect()  # bits / 8 bytes
    out: dict[int, dict[int, bytes]] = {s: {} for s in sizes}
    for r in rows:
        out[r.shard][int(r.chunk)] = bytes(r.bytes)
    return out


class Cascade:
    """Exact membership over a universe of keys."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        """True where key is listed: fall out of an even level, or stay in to an odd end."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.holds(key), out).otherwise(F.lit(level.number % 2 == 1))
        return out


def build_cascades(universe: DataFrame, shards: int = 1, own: Sequence[int] = (0,), rate: float = FALSE_POSITIVES) -> dict[int, Cascade]:
    """From rows (key string, listed boolean), each key once: the cascades of the shards in own, each over its part of the universe.

    A level of all of them takes one aggregation over the keys still in question, which are written once a level: after the first, the listed and one in a hundred others.
    """
    key = F.col("key")
    asked = universe.withColumn("shard", shard_of(key, shards))
    if len(own) < shards:
        asked = asked.filter(F.col("shard").isin(*own))
    levels: dict[int, list[Level]] = {s: [] for s in own}
    number = 0
    while True:
        side = F.col("listed") if number % 2 == 0 else ~F.col("listed")
        counts = {r.shard: r.n for r in asked.filter(side).groupBy("shard").agg(F.count("*").alias("n")).collect()}
        going = list(own) if not number else [s for s in own if counts.get(s)]
        if not going:
            return {s: Cascade(ls) for s, ls in levels.items()}
        sizes = {s: size_for(counts.get(s, 0), rate) for s in going}
        chunks = filter_chunks(asked.filter(side), number, sizes)
        held = F.lit(False)  # a shard that has come to its end has nothing in question
        for s in going:
            levels[s].append(Level(number, *sizes[s], chunks[s]))
            held = F.when(F.col("shard") == s, levels[s][-1].holds(key)).otherwise(held)
        asked = settle(asked.filter(held), "url-asked")
        number += 1


def build_cascade(universe: DataFrame, rate: float = FALSE_POSITIVES) -> Cascade:
    return build_cascades(universe, rate=rate)[0]


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def in_shards(cascades: dict[int, Cascade], shards: int) -> Callable[[Column], Column]:
    """Whether a key is listed by the cascade of its shard; false for shards that aren't among cascades."""

    def listed(key: Column) -> Column:
        if shards == 1:
            return cascades[0].listed(key)
        found = F.lit(False)
        for s, c in cascades.items():
            found = F.when(shard_of(key, shards) == s, c.listed(key)).otherwise(found)
        return found

    return listed


def marked(rows: DataFrame, keys: Column, universe: DataFrame, out: str, shard_keys: int = SHARD_KEYS, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """rows with out: whether one of keys (an array) is listed. universe: (key, listed), written."""
    shards = max(1, -(-universe.filter("listed").count() // shard_keys))
    for first in range(0, shards, at_once):
        own = range(first, min(first + at_once, shards))
        cascades = build_cascades(universe, shards, own)
        found = F.exists(keys, in_shards(cascades, shards))
        rows = rows.withColumn(out, found if not first else F.col(out) | found)
        if first + at_once < shards:  # the constants of one pass at a time
            rows = settle(rows, "url-pass")
    return rows


def default_list(rows: DataFrame, terms: Sequence[str] = BLOCKED_TERMS) -> DataFrame:
    """(key): of rows (host, path, url), hosts by their labels, and directories by what most of their urls are."""
    hosts = rows.select(F.col("host").alias("key")).filter(F.col("key").rlike(r"(^|[.-])(" + "|".join(terms) + r")([.-]|$)")).distinct()
    place = directory_of(F.col("host"), F.col("path"))
    campaign = F.sum(F.coalesce(F.col("url").rlike(CAMPAIGN), F.lit(False)).cast("long"))
    urls = rows.filter(F.col("host") != "").groupBy(place.alias("key")).agg(F.count("*").alias("n"), campaign.alias("m")).filter((F.col("n") >= LEAST_URLS) & (2 * F.col("m") > F.col("n")))
    return hosts.unionByName(urls.filter(F.col("key").endswith("/")).select("key")).distinct()


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, terms: Sequence[str] = BLOCKED_TERMS, listed: DataFrame | None = None, shard_keys: int = SHARD_KEYS, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    listed: keys (column key) that are blocked where no rule fits, as hosts with their subdomains or directories "host/part/"; by default default_list().
    """
    full = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = full.drop("url")
    mark = settle((default_list(full, terms) if listed is None else listed.select("key")).dropna().distinct().withColumn("listed", F.lit(True)), "url-list")
    counts = label_counts(mark)
    keys = F.array_append(domains_of(F.col("host"), counts), directory_of(F.col("host"), F.col("path")))
    places = rows.select("host", directory_of(F.col("host"), F.col("path")).alias("place")).distinct()  # before keys are listed, so that each is once
    every = places.select(F.explode(F.array_append(domains_of(F.col("host"), counts), F.col("place"))).alias("key")).distinct()
    universe = settle(every.join(mark, "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False))), "url-keys")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    blocked = free_name(rows, "blocked")
    rows = marked(rows, keys, universe, blocked, shard_keys, at_once)
    found = F.coalesce(verdict, F.when(F.col(blocked), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), found.alias("verdict"))
