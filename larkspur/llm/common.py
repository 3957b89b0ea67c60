"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of text that one numpy pass works on; bounds a worker's memory whatever a batch holds.
PASS_BYTES = 2 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def learnable(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row may be learned from: its id is known and outside the held-out fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds != fold, F.lit(False))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, 2 * ``rows`` at most, by a hash of the key: for fitting a model, nothing else.

    The hash is compared with a share of its range, so nothing is sorted and equal tables give equal rows.
    """
    share = min(1.0, rows / max(df.count(), 1))
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * rows)


def join_small(big: DataFrame, small: DataFrame, keys: list[str], by: str, parts: int = 64) -> DataFrame:
    """Inner join with a table of few rows, whose keys repeat without bound in the large one.

    Where the small side is not broadcast by its measured size, a key's rows are dealt into parts by a hash of
    the column ``by``, and each part meets a copy of the small table's row; no key lands in one task.
    """
    part = fresh(big, "_part")
    dealt = big.withColumn(part, F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    copies = small.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(copies, [*keys, part]).drop(part)


def passes(texts: pa.Array, limit: int = PASS_BYTES) -> Iterator[list[bytes]]:
    """The texts in order as UTF-8 (null: empty), in lists of about ``limit`` bytes; no text is cut."""
    batch: list[bytes] = []
    size = 0
    for value in texts.cast(pa.large_binary()):
        raw = value.as_py() or b""
        if batch and size + len(raw) > limit:
            yield batch
            batch, size = [], 0
        batch.append(raw)
        size += len(raw)
    if batch:
        yield batch


def pieces(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes, cut only at white space, so a long text needs little memory at once."""
    at = 0
    while len(raw) - at > size:
        cut = _SPACE.search(raw, at + size)
        if cut is None:
            break
        yield raw[at : cut.start()]
        at = cut.end()
    yield raw[at:] if at else raw


def joined(batch: list[bytes], mark: bytes = b"\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one byte array, each followed by ``mark``; where each starts and its length without the mark."""
    lengths = np.fromiter(map(len, batch), np.int64, len(batch))
    starts = np.zeros(len(batch), np.int64)
    np.cumsum(lengths[:-1] + len(mark), out=starts[1:])
    return np.frombuffer(mark.join(batch) + mark, np.uint8), starts, lengths


def counted(flags: np.ndarray) -> np.ndarray:
    """Prefix counts with a leading zero: ``counted(f)[b] - counted(f)[a]`` flags lie in [a, b)."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:], dtype=np.int32)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits stirred."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64; a process makes its own."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def grow(self, size: int) -> None:
        if len(self.up) < size:
            tables = []
            for base in (self.BASE, pow(self.BASE, -1, 1 << 64)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                tables.append(np.cumprod(table, dtype=np.uint64))
            self.up, self.down = tables


_powers = _Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number of the bytes from each start to its end, all of them, by prefix sums of a polynomial."""
    _powers.grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers.up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers.down[starts])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the last one is the intercept.

    Without rows of both labels the weights are zero and the intercept is the smoothed log odds.
    """
    n, d = x.shape
    w = np.zeros(d + 1)
    if n == 0 or y.min() == y.max():
        w[-1] = np.log((y.sum() + 1) / (n - y.sum() + 1))
        return w
    x = np.hstack([x, np.ones((n, 1))])
    ridge = np.full(d + 1, l2 * n)
    ridge[-1] = 1e-6 * n
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w
