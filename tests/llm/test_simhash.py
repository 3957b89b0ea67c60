import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import SPACE, empty, long_text, odd, plain

from larkspur.llm import queries, simhash
from larkspur.llm.components import connected


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = SPACE.findall(low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=3):
    """(doc_id, print) rows -> component of each row, by all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [(d, f"{p:016x}", min(least[find(i)], default=None)) for i, (d, p) in enumerate(rows)]


def test_query_equals_brute_force(spark, small_dir):
    rows = [(r.doc_id, brute_print(r.text)) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert plain(queries.QUERIES["op1_simhash_near_dedup"](spark, small_dir)) == sorted(brute_components(rows), key=repr)


def test_odd_rows(spark):
    df = odd(spark)
    rows = [(r.doc_id, brute_print(r.text)) for r in df.collect()]
    assert plain(simhash.near_duplicates(df)) == sorted(brute_components(rows), key=repr)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and ids.count(None) == 1 and ids.count(2) == 1 and 3 not in ids and 4 not in ids


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.one_of_each(empty(spark)).collect() == []


def test_pieces_of_a_long_text_hash_like_the_whole():
    text = long_text(150_000)
    assert simhash.fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("distance,block", [(3, 4096), (3, 8), (1, 16), (6, 16)])
def test_links_of_clusters(spark, distance, block):
    """Dense groups and chains, over blocks far smaller than the groups."""
    rng = random.Random(distance)
    values = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(60):
            at ^= 1 << rng.randrange(64)
            values.add(at)
            values.add(at ^ sum(1 << b for b in rng.sample(range(64), 3)))
    values |= {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fp long").cache()
    tree = simhash.links(nodes, "fp", distance, block)
    edges = [tuple(r) for r in tree.collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= distance for a, b in edges)
    got = {r.node: r.root for r in connected(tree, "a", "b").collect()}
    want = {d: c for d, _, c in brute_components([(v, v & (1 << 64) - 1) for (v,) in signed], distance)}
    assert {v: got.get(v, v) for v in want} == want


@pytest.mark.parametrize("skew", [0.5, 0.05])
def test_thresholds_cover_every_pair(skew):
    """Whatever the bits look like, the thresholds obey the pigeonhole sum."""
    rng = np.random.default_rng(3)
    bits = (rng.random((500, 64)) < skew).astype(np.int64)
    for total in (1, 500, 10**9):
        parts = simhash.allocate(total, bits.T @ bits * max(total // 500, 1), 3)
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        assert sum(p.threshold for p in parts) == 3 - len(parts) + 1


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}


def kept(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return sorted((tuple(r) for r in simhash.one_of_each(df, **options).collect()), key=repr)


A, B = "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"


def test_one_of_each_by_component_and_not_by_id(spark):
    assert kept(spark, [(5, A, "x"), (5, B, "x"), (3, A, "x")]) == [(3, A, "x"), (5, B, "x")]
    assert kept(spark, [(None, A, "x")] * 4 + [(9, A, "y")]) == [(9, A, "y")]
    assert kept(spark, [(None, A, "x")] * 4 + [(None, B, "x")]) == [(None, B, "x"), (None, A, "x")]
    assert kept(spark, [(1, None, "x"), (2, "", "x"), (1, "", "x"), (7, A, "x"), (7, A, "x")])[-1] == (7, A, "x")
    assert len(kept(spark, [(1, None, "x"), (2, "", "x"), (1, "", "x"), (1, " ", "x")])) == 1


def test_hot_fingerprints_are_sent_to_the_rows(spark, monkeypatch):
    """Rows of large groups of copies get the same component as by shuffle."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=30)) for _ in range(40)]
    rows = [(i, texts[0] if i % 3 == 0 else texts[rng.randrange(40)]) for i in range(600)] + [(None, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr)
    monkeypatch.setattr(simhash, "HOT_ROWS", 20)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr) == want and len(want) == 601
