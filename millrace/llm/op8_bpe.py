"""Byte-level BPE, encoding and decoding, by a two-tier lookup.

A text is split by the tokenizer's pattern. A pre-token that is itself in the vocabulary is resolved by a minimal perfect hash:
its slot is computed from a displacement of its bucket, and the entry in the slot is compared with it. Any other pre-token is
merged by a heap of adjacent pairs over linked bytes, lowest rank first and leftmost among equals. Workers keep a bounded memory
of pre-tokens that they have met.

The vocabulary is read once by the driver and broadcast; its size is that of the rank file, whatever the corpus. Ids are kept as
binary columns of little-endian unsigned 32-bit integers. Defined results: a null text is an empty one, with no ids; texts are
encoded whole; strings that look like special tokens are ordinary text; unknown ids raise an error when decoded;
of merges of one rank the first in the text comes first; repeated rows give equal rows; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fields, table, text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens that a worker remembers: the newer half is kept when the older half goes.
REMEMBERED = 300_000
#: Rows that a worker hands back at a time.
SLICE = 500


class MinimalPerfectHash:
    """Places n different byte strings in n slots: buckets are placed largest first by the first displacement that fits; those of one key take the slots left."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n, self.buckets = len(keys), max(1, len(keys) // 3)
        self.slots: list[bytes | None] = [None] * self.n
        self.shift = [0] * self.buckets
        held: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in keys:
            held[(h := xxhash.xxh3_64_intdigest(key)) % self.buckets].append((h, key))
        order = sorted(range(self.buckets), key=lambda b: -len(held[b]))
        free = 0
        for b in order:
            if len(held[b]) > 1:
                d = 1
                while len(places := {self._place(h, d) for h, _ in held[b]}) < len(held[b]) or any(self.slots[p] is not None for p in places):
                    d += 1
                self.shift[b] = d
                for h, key in held[b]:
                    self.slots[self._place(h, d)] = key
            elif held[b]:
                while self.slots[free] is not None:
                    free += 1
                self.shift[b], self.slots[free] = -free - 1, held[b][0][1]

    def _place(self, h: int, d: int) -> int:
        x = (h ^ d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (x ^ x >> 32) % self.n

    def find(self, key: bytes) -> int:
        """The slot of a key; -1 for any other string."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        place = -d - 1 if d < 0 else self._place(h, d)
        return place if self.slots[place] == key else -1


class Coder:
    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.hash = MinimalPerfectHash(list(self.ranks))
        self.packed = [struct.pack("<I", self.ranks[x]) for x in self.hash.slots]
        self.tokens = {i: x for x, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.met: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        n, rank = len(word), self.ranks
        end, before, gone = list(range(1, n + 1)), list(range(-1, n)), bytearray(n + 1)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if gone[i] or j >= n or end[j] != stop:
                continue
            end[i], gone[j] = stop, 1
            if stop < n:
                before[stop] = i
                if (r := rank.get(word[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := rank.get(word[(p := before[i]) : stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        ids, i = [], 0
        while i < n:
            ids.append(rank[word[i : end[i]]])
            i = end[i]
        return ids

    def one(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is None:
            raw = word.encode()
            slot = self.hash.find(raw)
            ids = self.packed[slot] if slot >= 0 else struct.pack(f"<{len(found := self.merge(raw))}I", *found)
        if 2 * len(self.met) >= REMEMBERED:
            self.older = dict(self.met)
            self.met.clear()
        self.met[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        met, one = self.met.get, self.one
        return b"".join([met(w) or one(w) for w in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def sliced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE]


_coders: dict[str, Coder] = {}


def coder(ranks: bytes, pattern: str) -> Coder:
    """One for each worker and vocabulary."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _coders:
        _coders[key] = Coder(ranks, pattern)
    return _coders[key]


class Tokenizer:
    """encode(), decode() and both() make columns. ranks: bytes of a rank file; pattern: what splits texts."""

    def __init__(self, spark: SparkSession, ranks: bytes, pattern: str = public_tokenizers.PATTERN) -> None:
        shared = spark.sparkContext.broadcast(ranks)

        @F.pandas_udf("binary")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = coder(shared.value, pattern)
            for texts in sliced(batches):
                yield pd.Series([own.encode(x) for x in texts], dtype=object)

        @F.pandas_udf("binary")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = coder(shared.value, pattern)
            for ids in sliced(batches):
                yield pd.Series([own.decode(x) for x in ids], dtype=object)

        @F.pandas_udf(fields("ids binary, decoded binary"))
        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            own = coder(shared.value, pattern)
            for texts in sliced(batches):
                ids = [own.encode(x) for x in texts]
                yield pd.DataFrame({"ids": ids, "decoded": list(map(own.decode, ids))})

        self._encode, self._decode, self._both = encode, decode, both

    def encode(self, text: str | Column) -> Column:
        return self._encode(text_of(text))

    def decode(self, ids: str | Column) -> Column:
        """Bytes; cast them to string if they are known to be whole characters."""
        return self._decode(ids)

    def both(self, text: str | Column) -> Column:
        """A struct of the ids and of what they decode to, in one pass."""
        return self._both(text_of(text))


def rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op8_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Tokenizer(spark, rank_file(public_tokenizers.path(VOCABULARY)))
    back = table(spark, sf_dir, "documents").select("doc_id", tokenizer.both("text").alias("b")).select("doc_id", "b.ids", "b.decoded")
    return back.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
