"""Byte-level BPE: distinct words are encoded once, by Spark higher-order functions.

Texts are cut by the split pattern. The distinct words of each input split go into one table of distinct
words; there a fold merges, step by step, the adjacent pair of lowest rank over the array of a word's
byte tokens. Ranks of pairs come from a literal table addressed by a hash without collisions. The ids
of every word go back to the splits that use it, and each split writes its documents' ids from them.
Decoding concatenates the byte pieces of the ids.

Texts are never shuffled: words are sent, once per split. A split is known by its file and the place
where it starts, which is the same in both scans of the files.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import regex
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.let import let
from docflow.session import pin_file_splits, workspace
from llm.common import tidy
from llm.warc import _open

# A fold's work grows with the square of the word's length; longer words go to a heap, in the tasks that use them.
FOLD_BYTES = 256
# Documents whose results are held at once.
SLICE = 250
NO_RANK = 1 << 30
_KEYS, _SLOTS = 1 << 16, 1 << 17
# Odd numbers below 2**17: no product leaves 64 bits.
_MIX = (40503, 65599, 104729, 99991, 75707, 130043)


@dataclass
class Vocabulary:
    """Ranks by byte string, and the split pattern."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """Read a rank file: a base64 byte string and its rank on each line."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def id_bits(self) -> int:
        """Bits that hold any id."""
        return max(1, max(self.ranks.values()).bit_length())

    def pair_table(self) -> tuple[list[int], list[int]]:
        """Displacements and slots of a hash table from pairs of ids to the id of their merge.

        Keys of one bucket are moved together until all fall into free slots; a slot holds key and id, 0 if it
        is free. The table is part of the plan, whose text the driver prints: short numbers matter.
        """
        pairs = {}
        for word, rank in self.ranks.items():
            for cut in range(1, len(word)):
                left, right = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        slots = _SLOTS
        while slots < 1.1 * len(pairs):
            slots *= 2
        x, y = np.array([k[0] for k in pairs], np.int64), np.array([k[1] for k in pairs], np.int64)
        merged = np.array(list(pairs.values()), np.int64)
        bucket = (x * _MIX[0] + y * _MIX[1]) & (_KEYS - 1)
        base, stride = x * _MIX[2] + y * _MIX[3], (x * _MIX[4] + y * _MIX[5]) | 1
        del pairs
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        groups = sorted(np.split(order, cuts), key=len, reverse=True)
        table, moves, bits = np.zeros(slots, np.int64), [0] * _KEYS, self.id_bits()
        for group in groups:
            if not len(group):
                continue
            for move in range(1 << 15):
                at = (base[group] + move * stride[group]) & (slots - 1)
                if not table[at].any() and len(np.unique(at)) == len(at):
                    break
            else:
                raise ValueError("no free slots for a bucket of pairs")
            moves[int(bucket[group[0]])] = move
            table[at] = (x[group] << 2 * bits) | (y[group] << bits) | merged[group]
        return moves, table.tolist()


def _literal(values: list[int], kind: str) -> Column:
    """A long array as one literal: the parser makes it from text, once, when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def encode_word(word: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word (binary): a fold of ranked merges over the array of its byte tokens."""
    moves, slots = vocabulary.pair_table()
    of_byte = [vocabulary.ranks[bytes([b])] for b in range(256)]
    size, bits = len(slots), vocabulary.id_bits()
    # Pairs of single bytes, where every fold starts, have a table of their own. A missing
    # rank is NULL there, which the minimum passes over.
    of_two = [vocabulary.ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
    tables = F.struct(
        _literal(moves, "int").alias("moves"),
        _literal(slots, "bigint").alias("slots"),
        _literal(of_byte, "int").alias("bytes"),
        _literal(of_two, "int").alias("twos"),
    )

    def merge(t: Column, left: Column, right: Column) -> Column:
        """Id of two tokens' merge, or ``NO_RANK``."""
        x, y = left.cast("long"), right.cast("long")
        move = F.get(t["moves"], (x * _MIX[0] + y * _MIX[1]).bitwiseAND(_KEYS - 1).cast("int"))
        at = (x * _MIX[2] + y * _MIX[3] + move * (x * _MIX[4] + y * _MIX[5]).bitwiseOR(F.lit(1).cast("long"))).bitwiseAND(size - 1)
        entry = F.get(t["slots"], at.cast("int"))
        key = F.shiftleft(x, bits) + y
        return let(entry, lambda e: F.when((e > 0) & (F.shiftright(e, bits) == key), e.bitwiseAND((1 << bits) - 1).cast("int")).otherwise(NO_RANK))

    def folded(t: Column) -> Column:
        # In Latin-1 every byte is one character, whose code is the byte.
        codes = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), lambda c: F.ascii(c))

        def begin(p: Column) -> Column:
            tokens = F.transform(p, lambda b: F.get(t["bytes"], b))
            ranks = F.transform(F.slice(p, F.lit(1), F.size(p) - 1), lambda b, i: F.get(t["twos"], b * 256 + F.get(p, i + 1)))
            return F.struct(tokens.alias("tokens"), ranks.alias("ranks"))

        def step(state: Column) -> Column:
            least = F.array_min(state["ranks"])

            def merged_at(low: Column, i: Column) -> Column:
                # The pair at places i and i + 1, counted from 1, becomes one token.
                p, r = state["tokens"], state["ranks"]
                before, after = F.slice(p, F.lit(1), i - 1), F.slice(p, i + 2, F.size(p))
                left = F.when(i > 1, F.array(merge(t, F.get(p, (i - 2).cast("int")), low))).otherwise(F.expr("cast(array() as array<int>)"))
                right = F.when(i < F.size(r), F.array(merge(t, low, F.get(p, (i + 1).cast("int"))))).otherwise(
                    F.expr("cast(array() as array<int>)")
                )
                kept = F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0)))
                return F.struct(
                    F.concat(before, F.array(low), after).alias("tokens"),
                    F.concat(kept, left, right, F.slice(r, i + 2, F.size(r))).alias("ranks"),
                )

            return F.when(least.isNull() | (least >= NO_RANK), state).otherwise(
                let(F.struct(least.alias("low"), F.array_position(state["ranks"], least).cast("int").alias("i")), lambda m: merged_at(m["low"], m["i"]))
            )

        steps = F.slice(F.sequence(F.lit(1), F.length(word)), F.lit(1), F.length(word) - 1)
        return F.aggregate(steps, let(codes, begin), lambda s, _: step(s), lambda s: s["tokens"])

    return let(tables, folded)


def encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap, for words of any length."""
    n = len(word)
    start, after, before = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    end, alive, heap = list(range(1, n + 1)), [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(word[start[i] : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        # The entry is stale if one of its tokens has been merged since.
        if not alive[i] or after[i] >= n or end[after[i]] != stop or start[i] == stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[start[i] : end[i]]] for i in range(n) if alive[i]]


def _numbered(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    split = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    return documents.select(split.alias("split"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def word_table(documents: DataFrame, vocabulary: Vocabulary, folder: str) -> None:
    """Write the ids of the distinct words of each split of ``split, text`` below ``folder``.

    Words that are tokens by themselves need no merging and are left out. Words too long for a fold
    have no ids yet.
    """
    ranks, pattern = vocabulary.ranks, vocabulary.pattern

    @tidy
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        current, seen = None, set()

        def flush() -> pa.RecordBatch:
            fresh = [w for w in (s.encode("utf-8", "surrogatepass") for s in seen) if w not in ranks]
            return pa.RecordBatch.from_arrays(
                [pa.array([current] * len(fresh), pa.int64()), pa.array(fresh, pa.binary())], names=["split", "word"]
            )

        for batch in batches:
            for split, text in zip(batch.column("split").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if split != current:
                    if seen:
                        yield flush()
                    current, seen = split, set()
                seen.update(find(text))
        if seen:
            yield flush()

    used = documents.select("split", "text").mapInArrow(words, "split long, word binary")
    # A word's list holds each split at most once (twice, if one comes in two parts).
    grouped = used.groupBy("word").agg(F.collect_set("split").alias("splits"))
    ids = F.when(F.length("word") <= FOLD_BYTES, encode_word(F.col("word"), vocabulary))
    spread = grouped.select("word", ids.alias("ids"), "splits").select(F.explode("splits").alias("split"), "word", "ids")
    spread.repartition("split").write.partitionBy("split").parquet(folder)


_ENCODED = "id long, ids binary, n_tokens long, ids_sha256 string, decoded binary, decoded_sha256 string"


def encode(
    documents: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    with_decoded: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id, ids, n_tokens, ids_sha256, decoded, decoded_sha256``.

    ``ids`` are the token ids as little-endian unsigned 32-bit integers, ``decoded`` the bytes they stand
    for (NULL where not asked for). Every match of the pattern is encoded separately and nothing is a
    special token. A NULL text is empty and has no tokens. Missing and repeated ids
    are kept as they are, an empty table gives no rows, other columns are ignored. The rows must
    come from files, whose splits both passes share; others count as a single split.
    """
    spark = documents.sparkSession
    pin_file_splits(spark)
    rows = _numbered(documents, id_col, text_col)
    folder = workspace(spark, "bpe-words")
    word_table(rows, vocabulary, folder)
    ranks, pattern = vocabulary.ranks, vocabulary.pattern

    @tidy
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for word, rank in ranks.items():
            pieces[rank] = word
        current, known = None, {}
        # Ids and decoded bytes take more room than the text: they leave in small batches.
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            out = []
            for split, number, text in zip(*(batch.column(c).to_pylist() for c in ("split", "id", "text")), strict=True):
                if split != current:
                    known = {}
                    current, known = split, _Words(ranks, _load(folder, split, ranks))
                ids = b"".join(map(known.__getitem__, find(text)))
                decoded = b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                out.append((number, ids if with_ids else None, len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded if with_decoded else None, hashlib.sha256(decoded).hexdigest()))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.string())
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["id", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"],
            )

    return rows.select("split", F.col("id").cast("long"), "text").mapInArrow(apply, _ENCODED).withColumnRenamed("id", "doc_id")


class _Words(dict):
    """Ids of a split's words; a word that is a token by itself is added when it is first met."""

    def __init__(self, ranks: dict[bytes, int], words: dict[str, bytes]):
        super().__init__(words)
        self.ranks = ranks

    def __missing__(self, word: str) -> bytes:
        self[word] = found = self.ranks[word.encode("utf-8", "surrogatepass")].to_bytes(4, "little")
        return found


def _load(folder: str, split: int, ranks: dict[bytes, int]) -> dict[str, bytes]:
    """The words of a split with their ids; a split without words beyond the tokens has no folder."""
    system, top = _open(f"{folder}/split={split}")
    if system.get_file_info(top).type == pafs.FileType.NotFound:
        return {}
    out = {}
    for found in system.get_file_info(pafs.FileSelector(top)):
        if not found.path.endswith(".parquet"):
            continue
        with system.open_input_file(found.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["word", "ids"]):
                lists = batch.column("ids")
                flat = lists.flatten().to_numpy().astype("<u4").tobytes()
                ends = (np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]) * 4
                for word, lo, hi in zip(batch.column("word").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    # A word too long for the fold has no ids yet.
                    ids = flat[lo:hi] if hi > lo else np.array(encode_long(word, ranks), "<u4").tobytes()
                    out[word.decode("utf-8", "surrogatepass")] = ids
    return out
