"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprints: 64 bits per text from the XXH64 hashes (seed 42) of its word shingles, Arrow-batched.
2. Equal fingerprints are one node, so exact copies, however many, cost one row.
3. Correlated bits are grouped into partitions. With m partitions and thresholds t_1 + ... + t_m =
   k - m + 1, two fingerprints at most k bits apart differ in at most t_i bits of some partition i
   (t_i = -1 leaves a partition out). The number of partitions and the thresholds are those of least
   estimated cost by dynamic programming; the estimates come from counts of all fingerprints. They
   decide the work only: every choice finds every link.
4. Probe: a partition with threshold t gives one bucket key per way to blank t of its bits, so two
   fingerprints within t there meet in a bucket. Buckets are cut into blocks of bounded size and every
   pair of blocks is one unit of work, however large the bucket.
5. Verify: a unit compares exact distances and returns a spanning forest of its links, at most one row
   per member. No pairs of a group are emitted, and none that could join two documents is lost.
6. Components of the forest by distributed label propagation; nothing but 64 x 64 bit counts is collected.

* null or empty text, or one without words: fingerprint zero, linked like any other.
* null doc_id: its text takes part; a component of such rows only has a null component_id, and one of them is kept.
* repeated rows: each gets its row. An empty table gives an empty result. Columns are chosen by name.
* a very long text is hashed piece by piece: memory for a megabyte of its words, not for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import fresh, pieces
from larkspur.llm.components import connected
from larkspur.session import cut_lineage

BITS = 64
#: Fingerprints in a block of a bucket: a unit of work holds two blocks.
BLOCK = 4096
_ORDER = np.array([[(byte >> bit) & 1 for bit in range(8)] for byte in range(256)], np.int64)


def shingle_hashes(raw: bytes, length: int) -> Iterator[list[int]]:
    """XXH64 of every word shingle of a text in lower case (A-Z only), in lists of bounded size."""
    digest = xxhash.xxh64_intdigest
    tail: list[bytes] = []
    short = True
    for piece in pieces(raw.lower()):
        words = tail + piece.split()
        if len(words) >= length:
            short = False
            text = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            first = [0, *ends[: len(words) - length].tolist()]
            yield [digest(text[a:b], 42) for a, b in zip(first, (ends[length - 1 :] - 1).tolist())]
            tail = words[len(words) - length + 1 :]
        else:
            tail = words
    if short and tail:
        yield [digest(b" ".join(tail), 42)]


def fingerprint(raw: bytes, length: int = 3) -> int:
    """Bit b is set if over half of the shingle hashes have it set; no words: zero."""
    counts, total = np.zeros((8, 256), np.int64), 0
    for hashes in shingle_hashes(raw, length):
        seen = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[k] += np.bincount(seen[:, k], minlength=256)
        total += len(hashes)
    ones = (counts @ _ORDER).reshape(-1)  # by byte, then by bit within the byte
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprint_column(text: Column, length: int = 3) -> Column:
    """The fingerprint of a text as a long (two's complement)."""

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw = texts.cast(pa.large_binary())
            values = np.fromiter((fingerprint(x.as_py() or b"", length) for x in raw), np.uint64, len(raw))
            yield pa.array(values.view(np.int64))

    return prints(text)


# ---- which partitions, which thresholds ---------------------------------------------------------


class Part(NamedTuple):
    """Bits of one partition and how many of them may differ (-1: not probed)."""

    bits: tuple[int, ...]
    threshold: int


def bit_counts(prints: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits how many have both set: 64 x 64 sums over all rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, total = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            total += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(both.ravel(), total))], names=["cell", "n"]
        )

    rows = prints.select(column).mapInArrow(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def _agreement(total: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For two random fingerprints: P(they agree on bit a and on bit b), P(they agree on a)."""
    n = max(total, 1)
    p11 = both / n
    one = np.diag(p11)
    p10, p01 = one[:, None] - p11, one[None, :] - p11
    return p11**2 + p10**2 + p01**2 + (1 - p11 - p10 - p01) ** 2, one**2 + (1 - one) ** 2


def group_bits(total: int, both: np.ndarray) -> list[int]:
    """An order of the bits in which each stands beside those it is most correlated with."""
    n = max(total, 1)
    one = np.diag(both) / n
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    tied = np.abs(both / n - np.outer(one, one)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    order = [int(tied.sum(0).argmax())]
    while len(order) < BITS:
        near = tied[order[-8:]].sum(0)
        near[order] = -1
        order.append(int(near.argmax()))
    return order


def _within(bits: list[int], most: int, pair: np.ndarray, single: np.ndarray) -> list[float]:
    """P(two random fingerprints differ in at most t of the bits), t = 0..most, as a first-order chain."""
    # state: (agree or not on the last bit, number of differences)
    now = np.zeros((2, most + 1))
    now[0, 0] = single[bits[0]]
    if most:
        now[1, 1] = 1 - single[bits[0]]
    for a, b in zip(bits, bits[1:]):
        agree_a, agree_b, both = single[a], single[b], pair[a, b]
        stay = both / max(agree_a, 1e-12)
        back = (agree_b - both) / max(1 - agree_a, 1e-12)
        nxt = np.zeros_like(now)
        nxt[0] = now[0] * stay + now[1] * back
        nxt[1, 1:] = (now[0] * (1 - stay) + now[1] * (1 - back))[:-1]
        now = nxt
    return np.cumsum(now.sum(0)).tolist()


def allocate(total: int, both: np.ndarray, distance: int, row_cost: float = 8.0) -> list[Part]:
    """Partitions and thresholds of least estimated cost.

    The cost of a partition with threshold t is what it makes: one bucket row per fingerprint and way to
    blank t bits (``row_cost`` each, they are shuffled) and the estimated candidate pairs (1 each).
    """
    pair, single = _agreement(total, both)
    order = group_bits(total, both)
    best: tuple[float, list[Part]] = (float("inf"), [])
    for m in range(1, distance + 3):
        edges = [round(i * BITS / m) for i in range(m + 1)]
        parts = [order[a:b] for a, b in zip(edges, edges[1:])]
        costs = []
        for bits in parts:
            near = _within(bits, distance, pair, single)
            keys = [len(list(combinations(range(len(bits)), t))) for t in range(distance + 1)]
            costs.append([0.0] + [row_cost * max(total, 1) * keys[t] + total * (total - 1) / 2 * near[t] for t in range(distance + 1)])
        # table[j][s]: least cost of the first j partitions whose thresholds sum to s - j
        goal = distance - m + 1
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            nxt: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (c, chosen) in table.items():
                for t in range(-1, distance + 1):
                    entry = (c + cost[t + 1], (*chosen, t))
                    if s + t not in nxt or entry < nxt[s + t]:
                        nxt[s + t] = entry
            table = nxt
        found = table[goal]
        if found[0] < best[0]:
            best = found[0], [Part(tuple(sorted(b)), t) for b, t in zip(parts, found[1])]
    return best[1]


def masks(parts: list[Part]) -> list[int]:
    """One mask per kind of bucket: the bits of a partition that must be equal (as a signed long)."""
    out = []
    for part in parts:
        for gone in combinations(part.bits, max(part.threshold, 0)) if part.threshold >= 0 else ():
            value = sum(1 << b for b in part.bits if b not in gone)
            out.append(value - (1 << BITS) if value >> 63 else value)
    return out


# ---- probe and verify ---------------------------------------------------------------------------


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (the value it was reached from, value) that connect whatever is linked among the values, by exact distances."""
    links, waiting = [], values
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            here = queue.pop()
            near = np.bitwise_count(waiting ^ here) <= distance
            if near.any():
                found = waiting[near]
                links += [(here, x) for x in found]
                queue += list(found)
                waiting = waiting[~near]
    return links


@lru_cache
def _link_udf(distance: int):
    @F.arrow_udf("array<struct<a: long, b: long>>")
    def links(units: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for unit in units:
            flat, ends = unit.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), unit.offsets.to_numpy()
            ends = ends - ends[0]
            out: list[list[dict] | None] = [None] * len(unit)
            sizes = np.diff(ends)
            two = np.flatnonzero(sizes == 2)
            a, b = flat[ends[two]], flat[ends[two] + 1]
            for i in two[np.bitwise_count(a ^ b) <= distance]:
                out[i] = [{"a": int(flat[ends[i]].view(np.int64)), "b": int(flat[ends[i] + 1].view(np.int64))}]
            for i in np.flatnonzero(sizes > 2):
                found = _forest(flat[ends[i] : ends[i + 1]], distance)
                if found:
                    out[i] = [{"a": int(x.view(np.int64)), "b": int(y.view(np.int64))} for x, y in found]
            yield pa.array(out, kind)

    return links


def links(prints: DataFrame, column: str, distance: int, block: int = BLOCK) -> DataFrame:
    """A spanning forest (a, b) of all links between the distinct fingerprints of the frame.

    The frame should be cheap to read twice (a written table). A bucket of n fingerprints is cut into n / ``block``
    blocks and each pair of blocks is a unit, so its rows repeat n / ``block`` times: exact, and bounded per task.
    """
    total, both = bit_counts(prints, column)
    kinds = masks(allocate(total, both, distance))
    fp = F.col(column)
    probes = prints.select(
        fp.alias("fp"),
        F.posexplode(F.array(*[fp.bitwiseAND(F.lit(mask).cast("long")) for mask in kinds])).alias("kind", "key"),
    )
    sizes = probes.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), blocks).cast("int")
    # A block meets itself (only where it is the sole one) and every other block of its bucket.
    dealt = (
        probes.join(sizes, ["kind", "key"])
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: (o != F.col("own")) | (F.col("blocks") == 1))))
        .select("fp", "kind", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    units = dealt.groupBy("kind", "key", "low", "high").agg(F.collect_list("fp").alias("members"))
    found = units.where(F.size("members") > 1).select(F.explode(_link_udf(distance)("members")).alias("link"))
    return found.select(F.least("link.a", "link.b").alias("a"), F.greatest("link.a", "link.b").alias("b")).distinct()


#: Rows of a fingerprint from which it counts as hot: at least this many, and more than a share of all rows.
HOT_ROWS, HOT_SHARE = 1000, 10_000


def _roots(nodes: DataFrame, distance: int, block: int) -> DataFrame:
    """The distinct fingerprints with the least fingerprint of their component (``root``)."""
    tree = cut_lineage(links(nodes, "fp", distance, block), "simhash-links")
    found = connected(tree, "a", "b").select(F.col("node").alias("fp"), "root")  # only fingerprints that have a link
    return nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, distance: int = 3, shingle: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row.

    Rows meet their component by fingerprint. A fingerprint with more rows than ``HOT_ROWS`` and than one in
    ``HOT_SHARE`` of all is sent to the rows instead (there are at most ``HOT_SHARE`` of them), so no task gets
    all rows of a group of copies.
    """
    prints = cut_lineage(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-prints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    rooted = _roots(nodes, distance, block)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = cut_lineage(rooted.join(smallest, "root").select("fp", "n", "component_id"), "simhash-classes")
    least = max(HOT_ROWS, prints.count() // HOT_SHARE)
    hot, cold = (classes.where(c).drop("n") for c in (F.col("n") > least, F.col("n") <= least))
    sent = prints.join(F.broadcast(hot.withColumnRenamed("component_id", "sent_id").withColumn("sent", F.lit(True))), "fp", "left")
    met = sent.where(F.col("sent")).select("doc_id", "fp", F.col("sent_id").alias("component_id"))
    others = sent.where(F.col("sent").isNull()).select("doc_id", "fp").join(cold, "fp")
    return met.unionByName(others).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, distance: int = 3, shingle: int = 3, block: int = BLOCK) -> DataFrame:
    """One row of each component, with its columns as they are: of the smallest doc_id, rows without one last.

    Of rows with that doc_id in the component the one with the smallest text hash stays, of equal rows one.
    Rows are told apart by doc_id and a 128-bit hash of the text; equal ones are thinned out before they are moved.
    """
    key = [fresh(docs, c) for c in ("_no_id", "_id", "_hash", "_hash2")]
    rank = fresh(docs, "_rank")
    text = F.coalesce("text", F.lit(""))  # no text and an empty one have the same fingerprint
    missing = F.lit(0).cast(docs.schema["doc_id"].dataType)
    values = (F.col("doc_id").isNull(), F.coalesce("doc_id", missing), F.xxhash64(text), F.xxhash64(text, F.lit(1)))
    prints = docs.select(*[v.alias(k) for k, v in zip(key, values)], fingerprint_column(F.col("text"), shingle).alias("fp"))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min(F.struct(*key)).alias("first")), "simhash-nodes")
    rooted = _roots(nodes.select("fp", "first"), distance, block)
    chosen = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.*"), "simhash-chosen")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = Window.partitionBy(*key).orderBy(F.xxhash64(*columns))
    keyed = docs.withColumns(dict(zip(key, values))).withColumn(rank, F.row_number().over(same)).where(F.col(rank) == 1)
    return keyed.join(chosen, key, "left_semi").select(*columns)
