"""URL verdicts: path rules, then a Bloom filter cascade over hosts.

The cascade answers exactly whether a key of the corpus is listed, without a
join. Level 1 encodes the listed keys; level 2 the keys of the corpus that pass
level 1 by mistake; level 3 the listed keys that pass level 2; and so on until
nothing passes by mistake. A key's answer is the parity of the first level that
it fails. As every key of the corpus took part in building the levels, every
answer about one is right.

Only DataFrame functions are used. A level's bits are one array of longs,
built by hashing, ``bit_or`` and one bounded collect, and reach the rows as a
scalar subquery. A hash of the key deals the universe into shards, as many as
the counted keys need for the levels of each to fit ``MAX_BITS``; every shard has
its own cascade. A pass over the rows carries the bits of one shard and asks
only for keys dealt to it. One shard holds about ten million listed keys; each
further one costs a narrow pass, whose rows are written before the next.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textops import fresh
from clickloom.session import cut_lineage, scratch_path

#: the most bits of all levels of one shard (8 MB)
MAX_BITS = 1 << 26
#: a bound below this could not hold the levels of a handful of keys
LEAST_BITS = 1 << 12

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: words that list a host when its first label has one between hyphens
LISTED_WORDS = ("adult", "ads", "bets", "casino", "farm", "pills", "spam")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``; both empty for null or without one."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.regexp_extract(url, _PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, null if none does. A
    rule fits its host and all subdomains where the path starts with its path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def domains(host: Column) -> Column:
    """A host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


@dataclass
class Level:
    seed: int
    bits: int
    hashes: int
    words: DataFrame

    def positions(self, key: Column) -> list[Column]:
        # 40 bits of each hash: their sums stay within a long under ANSI arithmetic
        one, two = (F.xxhash64(F.lit(s), key).bitwiseAND((1 << 40) - 1) for s in (self.seed, -1 - self.seed))
        return [F.pmod(one + F.lit(j) * two, F.lit(self.bits)) for j in range(self.hashes)]

    def passes(self, key: Column, words: Column) -> Column:
        out = F.lit(True)
        for at in self.positions(key):
            word = F.element_at(words, (F.shiftrightunsigned(at, 6) + 1).cast("int"))
            out = out & (F.getbit(word, at.bitwiseAND(63).cast("int")) == 1)
        return out


def _rate(n: float, m: float, level: int) -> float:
    """False positives a level aims at: few of the many others may pass the first, one in two a later one."""
    return 0.5 if level else min(0.5, n / (1.4143 * max(1, m)))


def _bits(n: float, rate: float) -> int:
    return 64 * max(1, ceil(n * log(1 / rate) / log(2) ** 2 / 64))


def expected_bits(n: float, m: float) -> int:
    """Bits of all levels for ``n`` listed keys among ``m`` others."""
    total = level = 0
    while n >= 1:
        rate = _rate(n, m, level)
        total += _bits(n, rate)
        n, m, level = m * rate, n, level + 1
    return total


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """The filter of ``keys`` (column key, ``n`` rows) with false positives near ``rate``."""
    bits = _bits(n, rate)
    level = Level(seed, bits, max(1, round(log2(1 / rate))), keys)
    at = F.explode(F.array(*level.positions(F.col("key"))))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    set_bits = keys.select(at.alias("at")).select(F.shiftrightunsigned("at", 6).alias("i"), one.alias("w"))
    spark = keys.sparkSession
    none = spark.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    by_word = set_bits.unionByName(none).groupBy("i").agg(F.bit_or("w").alias("w"))
    # bits / 64 rows, bounded by MAX_BITS, become one array
    dense = by_word.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda s: s["w"]).alias("words"))
    level.words = cut_lineage(dense)
    return level


def _shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(shards))


@dataclass
class Cascade:
    """The levels of every shard that holds a listed key, by shard."""

    shards: int
    levels: dict[int, list[Level]]

    def mark(self, rows: DataFrame, host: str, into: str) -> DataFrame:
        """``rows`` with a boolean: is the host or a parent domain listed?

        All columns of ``rows`` are written between the passes of two shards."""
        marked = rows.withColumn(into, F.lit(False))
        for i, (shard, levels) in enumerate(self.levels.items()):
            if i:
                # or the optimiser would put the bits of all shards into one pass
                marked = cut_lineage(marked)
            marked = self._pass(marked, host, into, shard, levels)
        return marked

    def _pass(self, rows: DataFrame, host: str, into: str, shard: int, levels: list[Level]) -> DataFrame:
        names = fresh(rows, *[f"_bits{i}" for i in range(len(levels))])
        rows = rows.withColumns({n: level.words.scalar() for n, level in zip(names, levels, strict=True)})

        def listed(key: Column) -> Column:
            # passing every level decides by their number, failing one by its place
            answer = F.lit(len(levels) % 2 == 1)
            for i in reversed(range(len(levels))):
                answer = F.when(levels[i].passes(key, F.col(names[i])), answer).otherwise(F.lit(i % 2 == 1))
            return answer if self.shards == 1 else (_shard_of(key, self.shards) == shard) & answer

        return rows.withColumn(into, F.col(into) | F.exists(domains(F.col(host)), listed)).drop(*names)


def _levels(encoded: DataFrame, other: DataFrame, max_bits: int) -> list[Level] | None:
    """The levels that tell the keys ``encoded`` from ``other``; None beyond ``max_bits``.

    Every level hashes anew, so that two keys that agree in one part in the next."""
    n, m = encoded.count(), other.count()
    levels: list[Level] = []
    total = 0
    while n:
        rate = _rate(n, m, len(levels))
        total += _bits(n, rate)
        if total > max_bits:
            return None
        level = _level(encoded, n, rate, len(levels) + 1)
        levels.append(level)
        if not m:
            break
        (bits,) = fresh(other, "_bits")
        passing = other.withColumn(bits, level.words.scalar()).where(level.passes(F.col("key"), F.col(bits))).select("key")
        encoded, other = cut_lineage(passing), encoded
        n, m = encoded.count(), n
    return levels


def _dealt(keys: DataFrame, shards: int) -> list[DataFrame]:
    """The keys of every shard, each read from a folder of its own."""
    if shards == 1:
        return [keys]
    path = scratch_path(keys.sparkSession, f"keys-{uuid.uuid4().hex}")
    dealt = keys.select("key", _shard_of(F.col("key"), shards).alias("shard"))
    # a shard's keys by several tasks, as the keys not listed may be many
    dealt.repartition("shard", F.pmod(F.xxhash64(F.lit(-1), "key"), F.lit(8))).write.partitionBy("shard").parquet(path)
    kept = keys.sparkSession.read.schema("key string, shard long").parquet(path)
    return [kept.where(F.col("shard") == s).select("key") for s in range(shards)]


def build(universe: DataFrame, listed: DataFrame, max_bits: int = MAX_BITS) -> Cascade:
    """The cascade for the keys ``listed`` over the complete key ``universe``
    (column key each, nulls ignored); no shard has more than ``max_bits``."""
    if max_bits < LEAST_BITS:
        raise ValueError(f"max_bits {max_bits} is below {LEAST_BITS}")
    universe = cut_lineage(universe.select("key").where(F.col("key").isNotNull()).distinct())
    inside = cut_lineage(universe.join(listed.select("key").distinct(), "key", "left_semi"))
    outside = cut_lineage(universe.join(inside, "key", "left_anti"))
    expected = expected_bits(inside.count(), outside.count())
    shards = 1
    while 1.1 * expected > shards * max_bits:
        shards *= 2
    while True:
        found: dict[int, list[Level]] = {}
        for shard, (ins, out) in enumerate(zip(_dealt(inside, shards), _dealt(outside, shards), strict=True)):
            levels = _levels(ins, out, max_bits)
            if levels is None:
                break
            if levels:
                found[shard] = levels
        else:
            return Cascade(shards, found)
        # hashing dealt one shard more than its share
        shards *= 2


def listed_hosts(keys: DataFrame) -> DataFrame:
    """The corpus's hosts that a word of ``LISTED_WORDS`` lists."""
    labels = F.split(F.element_at(F.split("key", r"\."), 1), "-")
    return keys.where(F.arrays_overlap(labels, F.array(*map(F.lit, LISTED_WORDS))) & F.col("key").contains("."))


def judge(pages: DataFrame, listed: DataFrame | None = None, rules=RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    The longest rule that fits decides; otherwise the cascade blocks a host that
    is listed itself or under a listed domain. ``listed`` (column key) defaults
    to the hosts of the corpus that ``LISTED_WORDS`` list. A null url or one
    without ``://`` has an empty host and path and is allowed. Repeated rows
    give repeated rows, an empty table none; only page_id and url are read."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = rows.select("host").distinct()
    universe = cut_lineage(hosts.select(F.explode(domains(F.col("host"))).alias("key")).distinct())
    cascade = build(universe, listed_hosts(universe) if listed is None else listed, max_bits)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    marked = cascade.mark(rows, "host", "_listed")
    return marked.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"))
