"""URL rules by Bloom filter cascades: exact answers from small filters, without a join.

A rule is a host with all its subdomains and the beginning of a path. Every URL gives the keys
under which a rule could stand for it: the last labels of its host with the beginnings of
its path, for the label counts and path lengths that rules have. A cascade tells
for every such key of the corpus whether a rule stands under it: its first filter holds
the listed keys, the second the corpus's unlisted keys that pass the first, the third
the listed keys that pass the second, and so on until nothing passes by mistake.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from kindred.storage import staged

# (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# Listed keys of one cascade. Filters take some 30 bits a key, so that those of one
# cascade stay below 32 MB; longer lists are cut by hash into several cascades, used in turn.
SHARD_KEYS = 1 << 22

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, _UPPER, _LOWER)


def url_host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return F.coalesce(lowered(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without a host's place."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits, and ``n_hashes`` places a key."""

    seed: int
    n_hashes: int
    words: np.ndarray

    @property
    def n_bits(self) -> int:
        return 64 * len(self.words)

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether keys with these two hashes may have been put in."""
        n = np.uint64(self.n_bits)
        place, step = first.view(np.uint64) % n, second.view(np.uint64) % n
        inside = np.ones(len(first), bool)
        for _ in range(self.n_hashes):
            inside &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
            place = (place + step) % n
        return inside


def level_hashes(key: Column, seed: int) -> list[Column]:
    """Two hashes of the key itself, others at every level: keys that clash once part later."""
    return [F.xxhash64(key, F.lit(2 * seed)), F.xxhash64(key, F.lit(2 * seed + 1))]


def _places(key: Column, seed: int, n_hashes: int, n_bits: int) -> Column:
    first, second = [
        # The remainder of the hash as an unsigned number.
        F.pmod(F.pmod(F.shiftrightunsigned(h, 1), F.lit(n_bits)) * 2 + h.bitwiseAND(F.lit(1)), F.lit(n_bits))
        for h in level_hashes(key, seed)
    ]
    return F.array(*[F.pmod(first + second * i, F.lit(n_bits)) for i in range(n_hashes)])


def bloom_level(keys: DataFrame, n_keys: int, chance: float, seed: int) -> Level:
    """Filter of the ``key`` column of a table that others pass with the given chance."""
    wanted = math.log2(1 / chance)
    n_words = max(1, math.ceil(max(n_keys, 1) * wanted / math.log(2) / 64))
    n_hashes = max(1, round(wanted))
    places = keys.select(F.explode(_places(F.col("key"), seed, n_hashes, 64 * n_words)).alias("place"))
    bits = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    found = bits.toArrow()
    words = np.zeros(n_words, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Level(seed, n_hashes, words)


class Cascade:
    """Filters that alternately hold listed keys and mistakes of the filter before."""

    def __init__(self, levels: Sequence[Level] = ()):
        self.levels = list(levels)

    @property
    def n_bytes(self) -> int:
        return sum(level.words.nbytes for level in self.levels)

    def hashes(self, key: Column) -> Column:
        """What ``holds`` needs of a key."""
        return F.array(*[h for level in self.levels for h in level_hashes(key, level.seed)])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether keys, a row of hashes each, are listed."""
        listed = np.zeros(len(hashes), bool)
        asked = np.arange(len(hashes))
        for depth, level in enumerate(self.levels):
            pair = hashes[asked, 2 * depth : 2 * depth + 2]
            passed = level.holds(np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1]))
            # Who stops at a filter of listed keys is not listed, at one of mistakes is.
            listed[asked[~passed]] = depth % 2 == 1
            asked = asked[passed]
        listed[asked] = len(self.levels) % 2 == 1
        return listed

    def first_listed(self, keys: Column, asked: Callable[[Column], Column] | None = None) -> Column:
        """Place, from 1, of the first listed key of an array of keys; 0 if none is.

        ``asked`` leaves out keys that this cascade was not built for.
        """
        if not self.levels:
            return F.lit(0)
        levels = self.levels

        @arrow_udf("int")
        def first(rows: pa.Array) -> pa.Array:
            counts = np.diff(rows.offsets.to_numpy())
            keys = rows.flatten()
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            hashes = keys.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            listed = np.zeros(len(known), bool)
            listed[known] = Cascade(levels).holds(hashes.reshape(-1, 2 * len(levels)))
            places = np.zeros(len(rows), np.int32)
            owner = np.repeat(np.arange(len(rows)), counts)
            starts = np.cumsum(counts) - counts
            hits = np.flatnonzero(listed)[::-1]
            places[owner[hits]] = hits - starts[owner[hits]] + 1
            return pa.array(places)

        def hashes(key: Column) -> Column:
            return self.hashes(key) if asked is None else F.when(asked(key), self.hashes(key))

        return first(F.transform(keys, hashes))

    def mistakes(self, keys: DataFrame) -> DataFrame:
        """Distinct keys of a table that pass the last filter."""
        level = self.levels[-1]
        last = Cascade([level])
        passing = keys.where(last.first_listed(F.array("key")) > 0)
        return passing.select("key").distinct()


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade that tells the ``key``s of ``listed`` from all other ``key``s of ``universe``.

    ``universe`` may hold keys many times. Only its number of distinct keys is estimated first, to
    size the first filter; which keys pass a filter by mistake is found exactly, over all of
    them, and only those are shuffled. A key that both tables hold counts as listed.
    """
    listed = staged(listed.select("key").where("key is not null").distinct(), "listed-keys")
    n_listed = listed.count()
    if not n_listed:
        return Cascade()
    n_others = universe.agg(F.approx_count_distinct("key")).first()[0] or 1
    # The first filter lets through about as many others as there are listed keys.
    chance = min(0.5, n_listed / (math.sqrt(2) * n_others))
    cascade = Cascade([bloom_level(listed, n_listed, chance, 0)])
    wrong = staged(cascade.mistakes(universe).join(listed, "key", "left_anti"), "cascade-0")
    right = listed
    while n_wrong := wrong.count():
        cascade.levels.append(bloom_level(wrong, n_wrong, 0.5, len(cascade.levels)))
        name = f"cascade-{len(cascade.levels)}"
        right, wrong = wrong, staged(cascade.mistakes(right), name)
    return cascade


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as a table of (host, path, verdict)."""
    names = ("host", "path", "verdict")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _candidate_keys(forms: Sequence[tuple[int, int]]) -> Column:
    """All keys of a URL with the given label counts and path lengths, longest first."""
    host, path = F.col("host"), F.col("path")
    n_labels = F.size(F.split(host, r"\."))
    made = [
        F.when(
            (n_labels >= labels) & (F.length(path) >= length) & (host != ""),
            F.struct(
                F.length(F.substring_index(host, ".", -labels)).alias("n_host"),
                F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)).alias("key"),
            ),
        )
        for labels, length in forms
    ]
    if not made:
        return F.array().cast("array<string>")
    keys = F.array_compact(F.array(*made))
    order = F.sort_array(
        F.transform(keys, lambda k: F.struct(F.length(k["key"]).alias("n"), k["n_host"], k["key"])),
        asc=False,
    )
    return F.transform(order, lambda k: k["key"])


def judged(
    pages: DataFrame,
    rules: DataFrame | None = None,
    default: str = "allow",
    url: str = "url",
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of each URL.

    ``rules`` has rows (host, path, verdict), verdict ``allow`` or ``block``, by default ``RULES``.
    A rule fits its host, A-Z in lower case, and all subdomains, if the path begins
    with the rule's, letter by letter; a rule without a path fits any. Of several the one that
    is longest as host and path together wins, among equals the one with the longer
    host; a key that is both allowed and blocked is blocked. ``default`` is the verdict where no rule fits, and
    ``rule`` is null there. Rules without a host or of another verdict, and nulls, are no rules.

    Two cascades are used: one tells which keys of the corpus are rules, the other which rules
    block. Rules are not joined to pages. Lists of more than ``shard_keys`` rules
    are cut by hash; pages then pass the cascades one after another, each a scan without a shuffle.
    The (labels, path length) forms that rules have come to the driver: a few hundred
    for published lists, and as many keys are made of each URL.

    A null URL and one without ``://`` have an empty host and path, and no rule. Null ids and repeated
    rows pass through; an empty table gives no rows. Of columns named like a result the
    result's is kept; all others stay.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    known = staged(
        rules.where("host <> '' and verdict in ('allow', 'block')")
        .select(lowered(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat("host", "path").alias("key"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("length"),
            "verdict",
        ),
        "rules",
    )
    forms = [tuple(r) for r in known.select("labels", "length").distinct().collect()]
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    found = pages.select(
        F.struct(*kept).alias("page"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    ).withColumns(
        {"keys": _candidate_keys(forms), "place": F.lit(0), "blocked": F.lit(False)}
    )
    universe = found.select(F.explode("keys").alias("key"))
    n_shards = math.ceil(known.count() / shard_keys)
    for shard in range(n_shards):

        def mine(key: Column, shard: int = shard) -> Column:
            return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(n_shards)) == shard

        own = known.where(mine(F.col("key")))
        listed = build_cascade(own, universe.where(mine(F.col("key"))))
        blocks = build_cascade(own.where("verdict = 'block'"), own.where("verdict = 'allow'"))
        found = found.withColumn(
            "other", listed.first_listed(F.col("keys"), mine if n_shards > 1 else None)
        ).withColumn("at_other", blocks.first_listed(F.array(F.get("keys", F.col("other") - 1))) > 0)
        better = F.expr("other > 0 and (place = 0 or other < place)")
        found = found.withColumns(
            {
                "place": F.when(better, F.col("other")).otherwise(F.col("place")),
                "blocked": F.when(better, F.col("at_other")).otherwise(F.col("blocked")),
            }
        ).drop("other", "at_other")
        if shard + 1 < n_shards:
            found = staged(found, "judged")
    verdict = (
        F.when(F.col("place") == 0, default)
        .when(F.col("blocked"), "block")
        .otherwise("allow")
    )
    rule = F.when(F.col("place") > 0, F.get("keys", F.col("place") - 1))
    return found.select("page.*", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
