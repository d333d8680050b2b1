"""Routing hash (32-bit Murmur3, seed 0, over UTF-8 bytes) and the shard it selects.

Spark's own ``hash()`` uses seed 42 and folds the trailing bytes differently, so it cannot place
documents in the hash ranges of an existing layout. Written as column arithmetic the hash costs
14 us a row (each product needs splitting under ANSI arithmetic); handing the key column alone to
numpy in Arrow batches costs 1 us, so that form is used. Spark still does all partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the 32-bit Murmur3 definition.
C1 = 0xCC9E2D51
C2 = 0x1B873593
ROUND_ADD = 0xE6546B64
FINAL_1 = 0x85EBCA6B
FINAL_2 = 0xC2B2AE35

_U32 = np.uint32
# So few long keys left are finished one by one.
_FEW = 8


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U32(bits)) | (x >> _U32(32 - bits))


def _scramble(word: np.ndarray) -> np.ndarray:
    return _rotate(word * _U32(C1), 15) * _U32(C2)


def _byte(data: np.ndarray, at: np.ndarray, j: int) -> np.ndarray:
    """Byte ``j`` after each position, at its place in a little-endian word."""
    return data[at + j].astype(_U32) << _U32(8 * j)


def _rest_of_key(h: int, raw: np.ndarray) -> int:
    """The rounds of one key over the rest of its words: plain integers beat arrays of few rows."""
    scrambled = _scramble(np.frombuffer(raw.tobytes(), "<u4"))
    for k in scrambled.tolist():
        h ^= k
        h = (((h << 13) | (h >> 19)) * 5 + ROUND_ADD) & 0xFFFFFFFF
    return h


def murmur3_of_batch(keys: pa.Array) -> np.ndarray:
    """Unsigned hashes of one Arrow batch of strings (a null slot hashes like an empty string)."""
    raw = keys.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    start, length = ends[:-1], np.diff(ends)
    body = raw.buffers()[2]
    # Three spare bytes let the last key's trailing word be read without a bounds test.
    data = np.append(np.frombuffer(body or b"", dtype=np.uint8), np.zeros(4, np.uint8))

    hashes = np.zeros(len(raw), _U32)
    words = length >> 2
    # Longest first: the keys that still have words are always the first so many.
    longest = np.argsort(-words, kind="stable")
    left = np.searchsorted(-words[longest], -np.arange(int(words.max(initial=0))), side="left")
    for i, n in enumerate(left.tolist()):
        if n <= _FEW:
            for row in longest[:n].tolist():
                hashes[row] = _rest_of_key(int(hashes[row]), data[start[row] + 4 * i : start[row] + 4 * words[row]])
            break
        rows = longest[:n]
        at = start[rows] + 4 * i
        word = _byte(data, at, 0) | _byte(data, at, 1) | _byte(data, at, 2) | _byte(data, at, 3)
        hashes[rows] = _rotate(hashes[rows] ^ _scramble(word), 13) * _U32(5) + _U32(ROUND_ADD)

    tail, at = length & 3, start + 4 * words
    word = sum(np.where(tail > j, _byte(data, at, j), _U32(0)) for j in range(3))
    hashes ^= _scramble(word) ^ length.astype(_U32)

    hashes = (hashes ^ hashes >> _U32(16)) * _U32(FINAL_1)
    hashes = (hashes ^ hashes >> _U32(13)) * _U32(FINAL_2)
    return hashes ^ hashes >> _U32(16)


@F.arrow_udf(T.IntegerType())
def _murmur3_udf(keys: pa.Array) -> pa.Array:
    signed = murmur3_of_batch(keys).view(np.int32)
    return pa.array(signed, mask=np.asarray(keys.is_null()))


def murmur3(key: Column | str) -> Column:
    """Murmur3 of the UTF-8 bytes of ``key`` as a signed INT; NULL for a NULL key."""
    column = F.col(key) if isinstance(key, str) else key
    return _murmur3_udf(column.cast("string"))


def shard_of_hash(signed_hash: Column, shards: int) -> Column:
    """Which of ``shards`` equal, contiguous ranges of the signed 32-bit space holds the hash.

    A NULL hash (document without an id) goes to the first shard.
    """
    if shards < 1:
        raise ValueError("a layout needs at least one shard")
    offset = signed_hash.cast("bigint") + F.lit(1 << 31)
    return F.coalesce(F.shiftright(offset * F.lit(shards), 32).cast("int"), F.lit(0))


def spread_of_hash(signed_hash: Column, tasks_per_shard: int, tie: Column | None = None) -> Column:
    """Which of a shard's writer tasks takes the document, in [0, tasks_per_shard).

    Uses hash bits the shard choice leaves free. ``tie`` (an integer column such as a timestamp
    or sequence number) separates copies of one hot id, which all share the same hash.
    """
    if tasks_per_shard < 1:
        raise ValueError("a shard needs at least one task")
    bits = F.shiftright(signed_hash.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)), 8)
    if tie is not None:
        bits = bits + F.pmod(tie.cast("bigint"), F.lit(tasks_per_shard))
    return F.coalesce(F.pmod(bits, F.lit(tasks_per_shard)).cast("int"), F.lit(0))
