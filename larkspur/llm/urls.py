"""URL filters by a cascade of Bloom filters: exact membership without a join.

Every URL has a small set of keys: each suffix of its host at a label border with each path prefix of a
length that some rule has. The keys of all URLs are the universe. Level 1 of a cascade encodes the listed
keys of the universe; level 2 the keys of the universe that level 1 takes for listed but are not; level 3
the listed keys that level 2 takes for those; and so on, until a level errs on no key. The first level
that does not hold a key then settles it, and it is right for every key of the universe, whatever the
false-positive rate of one level.

One cascade is built for allowed keys and one for blocked ones. The longest listed key of a URL wins; a
URL without one is allowed: the list holds what is to be blocked.

Filters are built on the executors (positions, words and their bits by aggregation). Their size follows
the number of rules that occur, never the number of URLs, and is checked: beyond ``MAX_BITS`` per level
rules are split by a hash into shards, and URLs are tested against one shard after the other.

* null URL or one without ``://``: host and path are empty, no key, verdict allow.
* rules without a host are left out; a rule that is both allowed and blocked is blocked.
* null page_id and repeated rows: each row on its own. An empty table gives an empty result, an empty
  list allows everything. Hosts and paths of any length are kept whole. Columns go by name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import fresh
from larkspur.session import cut_lineage

#: Share of false positives of one level, and the largest level that is sent to the executors.
ERROR, MAX_BITS = 0.01, 1 << 28


def positions(one: np.ndarray, two: np.ndarray, depth: int, bits: int, hashes: int) -> list[np.ndarray]:
    """Bits of keys in the level at this depth, from two hashes; every level scatters the keys anew."""
    salt = np.uint64((depth + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    a, b = (one ^ salt) * np.uint64(0xBF58476D1CE4E5B9), (two ^ salt) * np.uint64(0x94D049BB133111EB)
    a, b = a ^ (a >> np.uint64(29)), (b ^ (b >> np.uint64(32))) | np.uint64(1)
    return [((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(bits) for i in range(hashes)]


class Level(NamedTuple):
    words: np.ndarray
    bits: int
    hashes: int
    depth: int

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the filter takes the keys with these two hashes for members."""
        found = np.ones(len(one), bool)
        for at in positions(one, two, self.depth, self.bits, self.hashes):
            found &= self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1
        return found


def listed(levels: list[Level], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact membership of keys of the universe: the first level that rejects a key settles it."""
    answer = np.full(len(one), len(levels) % 2 == 1)
    open_ = np.ones(len(one), bool)
    for depth, level in enumerate(levels):
        rejected = open_ & ~level.holds(one, two)
        answer[rejected] = depth % 2 == 1
        open_ &= ~rejected
    return answer


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty without ``://``."""
    cut = F.instr(url, "://")
    rest = F.when(cut > 0, F.substr(url, cut + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of a URL (host suffix and path prefix, as one text), longest first.

    ``lengths`` are the lengths of the rules' paths: as many keys per label as the list has lengths.
    """
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    sizes = F.array(*[F.lit(n) for n in lengths])
    heads = F.transform(F.filter(sizes, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda h: F.concat(s, h))))
    longest = F.array_sort(pairs, lambda a, b: F.length(b) - F.length(a))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(longest)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def build_level(keys: DataFrame, count: int, depth: int) -> Level:
    """A filter over the distinct keys in column ``key``: positions and bits are made and merged on the executors."""
    bits = max(64, 64 * math.ceil(-count * math.log(ERROR) / math.log(2) ** 2 / 64))
    hashes = max(1, round(-math.log2(ERROR)))
    one, two = _hashes(F.col("key"))

    @F.arrow_udf("array<long>")
    def places(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (v.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for v in (a, b))
        return pa.array(list(np.stack(positions(x, y, depth, bits, hashes), 1).astype(np.int64)), pa.list_(pa.int64()))

    at = keys.select(F.explode(places(one, two)).alias("at"))
    merged = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("set"))
    words = np.zeros(bits // 64, np.int64)
    for r in merged.toLocalIterator():  # at most bits / 64 rows, of a list whose size is checked
        words[r["word"]] = r["set"]
    return Level(words.view(np.uint64), bits, hashes, depth)


def _holding(keys: DataFrame, levels: list[Level]) -> DataFrame:
    """The keys that the last level takes for members."""
    one, two = _hashes(F.col("key"))

    @F.arrow_udf("boolean")
    def held(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (v.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for v in (a, b))
        return pa.array(levels[-1].holds(x, y))

    return keys.where(held(one, two))


def cascade(listed_keys: DataFrame, universe: DataFrame, most: int = 60) -> list[Level]:
    """Levels that tell the listed keys of the universe from its other keys without error.

    Both frames have a column ``key`` without repeats. Each level is tested against the keys of the other
    side that its predecessors did not settle, a small and shrinking share.
    """
    inside = cut_lineage(universe.join(listed_keys, "key", "left_semi"), "cascade-listed")
    outside = universe.join(listed_keys, "key", "left_anti")
    levels: list[Level] = []
    now, other = inside, outside
    for _ in range(most):
        count = now.count()
        if count == 0:
            return levels
        levels.append(build_level(now, count, len(levels)))
        errors = cut_lineage(_holding(other, levels), "cascade-errors")
        now, other = errors, now
    raise RuntimeError(f"cascade not settled after {most} levels")


def rule_keys(rules: DataFrame) -> DataFrame:
    """key, verdict and path length of each rule (host, path, verdict); block wins over allow."""
    host = F.lower(F.col("host"))
    named = rules.where(F.coalesce(host, F.lit("")) != "").select(
        F.concat(host, F.coalesce(F.col("path"), F.lit(""))).alias("key"),
        F.length(F.coalesce(F.col("path"), F.lit(""))).alias("length"),
        "verdict",
    )
    return named.groupBy("key").agg(F.max("verdict").alias("verdict"), F.first("length").alias("length"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, the longest rule that fits (as host and path; else null) and the verdict of every page."""
    known = cut_lineage(rule_keys(rules), "url-rules")
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    split = split.withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>"))
    universe = cut_lineage(split.select(F.explode("keys").alias("key")).distinct(), "url-universe")
    shards = math.ceil(known.count() * 10 / MAX_BITS) or 1
    out = split
    hits = []
    for shard in range(shards):
        mine = F.pmod(F.xxhash64("key", F.lit(9)), F.lit(shards)) == shard
        part, ground = (known.where(mine), universe.where(mine)) if shards > 1 else (known, universe)
        both = [cascade(part.where(F.col("verdict") == v).select("key"), ground) for v in ("block", "allow")]
        name = fresh(out, f"hit{shard}")
        out = out.withColumn(name, _longest(F.col("keys"), both, shards, shard))
        hits.append(F.col(name))
    best = hits[0] if shards == 1 else F.array_max(F.array(*[F.struct(F.length(h["key"]).alias("n"), h.alias("hit")) for h in hits]))["hit"]
    return out.select(
        "page_id", "host", "path", best["key"].alias("rule"), F.coalesce(best["verdict"], F.lit("allow")).alias("verdict")
    )


def _longest(keys: Column, both: list[list[Level]], shards: int, shard: int) -> Column:
    """The first (longest) key that a cascade lists, with its verdict; block before allow."""
    hashed = F.transform(keys, lambda k: F.struct(*[h.alias(n) for n, h in zip(("one", "two"), _hashes(k))]))
    own = F.transform(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(9)), F.lit(shards)) == shard)

    @F.arrow_udf("struct<key: string, verdict: string>")
    def longest(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("key", pa.string()), ("verdict", pa.string())])
        for names, marks, mine in batches:
            flat = marks.flatten()
            one, two = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in (0, 1))
            ours = mine.flatten().to_numpy(zero_copy_only=False)
            block, allow = (listed(levels, one, two) & ours for levels in both)
            found = np.flatnonzero(block | allow)
            ends = names.offsets.to_numpy() - names.offsets[0].as_py()
            first = np.searchsorted(found, ends[:-1])
            text = names.flatten()
            out = []
            for f, end in zip(first.tolist(), ends[1:].tolist()):
                at = int(found[f]) if f < len(found) else end
                out.append({"key": text[at].as_py(), "verdict": "block" if block[at] else "allow"} if at < end else None)
            yield pa.array(out, kind)

    return longest(keys, hashed, own)
