"""Sequence packing by lexical retrieval: documents fill each other's windows by BM25.

Texts become token ids once, stored as Parquet in the shared folder. Document frequencies and the number of documents are counted
over all of them. Whole windows of a document stand alone and are never shuffled: they are full, so they neither need nor are neighbours. What is
left of a document, less than a window, is dealt to shards of a bounded number of tokens by range, in an order that puts those with
the same rarest tokens side by side (ranks of a byte-level BPE vocabulary grow with rarity; hashes of the ids and of the keys split
groups of copies). A shard is one inverted index of all its documents. It packs in order: a document is a seed, and all its
tokens are the query. Its unused neighbours fill the window, best first as long as they fit whole; the best that does not is cut to fill the window, and its rest is the next
seed. Where no neighbour is left, the next unused document fills. A shard's last open window is cut into sequences whose lengths are
powers of two, so nothing is padded.

Neighbours are those of the seed's shard: a neighbour in another shard is not found. The README has the share of each document's best
neighbours in the corpus that lie in its own shard.

The vocabulary is that of the named rank file, which gives the ids of its `tokenizers` twin; a text is split at the added tokens of
that twin first (`<|endoftext|>`), which get their own ids, as the library does; the vectors that come to the driver and
are broadcast have one number for each entry of the vocabulary.

Defined results: a null text is an empty one, and its only id is the end of the document; every id of every row, repeated rows
included, is in exactly one piece; a null document id is carried along; ties between neighbours go by their order in the shard; key columns may
have any names, those of the result's columns apart; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import fields, stored, table, text_of

VOCABULARY = "byte_bpe_50k.tiktoken"
TWIN = "byte_bpe_50k.json"
END = 0


@dataclass(frozen=True)
class Packing:
    """window: tokens of a sequence. shard_tokens: tokens of a shard, about."""

    window: int = 1024
    k1: float = 1.2
    b: float = 0.75
    shard_tokens: int = 1_000_000


_encodings: dict[str, tiktoken.Encoding] = {}


def added_tokens(name: str = TWIN) -> dict[str, int]:
    """The tokens that the library's file has besides its vocabulary, matched as they stand."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    assert not any(x[k] for x in found for k in ("single_word", "lstrip", "rstrip", "normalized")), found
    return {x["content"]: x["id"] for x in found}


def encoding(ranks: bytes, pattern: str, added: dict[str, int]) -> tiktoken.Encoding:
    key = hashlib.sha256(ranks + pattern.encode() + json.dumps(added).encode()).hexdigest()
    if key not in _encodings:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        _encodings[key] = tiktoken.Encoding(key[:16], pat_str=pattern, mergeable_ranks=table, special_tokens=added)
    return _encodings[key]


def rarest(ids: np.ndarray) -> int:
    """The two greatest ids as one number, the greatest first; a single id twice, 0 for none."""
    if not len(ids):
        return 0
    first = int(ids.max())
    others = ids[ids < first]
    return first << 16 | (int(others.max()) if len(others) else first)


def different(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Each id once, in no order. places: a number for each id there can be, written over."""
    at = np.arange(len(ids), dtype=places.dtype)
    places[ids] = at
    return ids[places[ids] == at]


def tokenized(docs: DataFrame, ranks: bytes, text: str, keys: tuple[str, ...], window: int, pattern: str = public_tokenizers.PATTERN, added: dict[str, int] | None = None) -> DataFrame:
    """keys (an array of strings), ids (two bytes each, the last is END), n, rest (ids that fill no window), place (what shards are ordered by: the rarest two ids of the rest) and salt."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    added = added_tokens() if added is None else added

    @F.pandas_udf(fields("ids binary, n long, rest long, place long, salt long"))
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoding(shared.value, pattern, added)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = []
                for text in batch.iloc[at : at + 1000]:
                    ids = np.append(coder.encode_to_numpy(text, allowed_special="all"), END).astype("<u2")
                    tail = ids[len(ids) - len(ids) % window :]
                    rows.append((ids.tobytes(), len(ids), len(tail), rarest(tail), zlib.crc32(tail.tobytes())))
                yield pd.DataFrame(rows, columns=["ids", "n", "rest", "place", "salt"])

    held = F.array(*[F.col(f"`{c}`").cast("string") for c in keys])
    return docs.select(held.alias("keys"), tokens(text_of(F.col(f"`{text}`"))).alias("t")).select("keys", "t.*")


def frequencies(tokens: DataFrame, size: int) -> np.ndarray:
    """Documents that have each id. Every task sums its own documents; one vector of the vocabulary's length comes to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, places = np.zeros(size, np.int64), np.empty(size, np.int32)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = [different(np.frombuffer(raw, "<u2"), places) for raw in batch["ids"].iloc[at : at + 1000]]
                total += np.bincount(np.concatenate(some), minlength=size)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"id": some, "n": total[some]})

    out = np.zeros(size, np.int64)
    for row in tokens.select("ids").mapInPandas(count, fields("id long, n long")).groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


class Index:
    """An inverted index of a shard's documents (ids that end with END)."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, packing: Packing) -> None:
        n = len(docs)
        found = [np.unique(x[:-1], return_counts=True) for x in docs]
        sizes = np.array([len(x[0]) for x in found])
        terms, counts = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        length = np.array([len(x) for x in docs])
        weight = (idf[terms] * counts * (packing.k1 + 1) / (counts + packing.k1 * (1 - packing.b + packing.b * length[owner] / mean))).astype(np.float32)
        order = np.argsort(terms, kind="stable")
        _, starts, held = np.unique(terms[order], return_index=True, return_counts=True)
        self.starts, self.stops, self.live = starts, starts + held, n
        self.owner, self.weight = owner[order], weight[order]
        slot = np.empty(len(terms), np.int64)
        slot[order] = np.repeat(np.arange(len(starts)), held)
        useful = np.flatnonzero(held[slot] > 1)  # an id that no other document of the shard has finds nothing
        self.queries, self.bounds, self.n = slot[useful], np.searchsorted(owner[useful], np.arange(n + 1)).tolist(), n

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document for the tokens of one."""
        terms = self.queries[self.bounds[doc] : self.bounds[doc + 1]]
        spans = [(a, b) for a, b in zip(self.starts[terms].tolist(), self.stops[terms].tolist(), strict=True) if a < b]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.owner[a:b] for a, b in spans]), np.concatenate([self.weight[a:b] for a, b in spans]), self.n)

    def drop(self, free: np.ndarray) -> None:
        """Leaves out the postings of used documents."""
        kept = free[self.owner] > 0
        at = np.concatenate(([0], np.cumsum(kept)))
        self.starts, self.stops, self.owner, self.weight = at[self.starts], at[self.stops], self.owner[kept], self.weight[kept]

    def ranked(self, doc: int, free: np.ndarray) -> Iterator[np.ndarray]:
        """Unused documents that share a token, by falling score and then in order: the best, then the others. free: 1 for the unused."""
        if (live := int(free.sum())) < 0.9 * self.live:
            self.drop(free)
            self.live = live
        score = self.scores(doc) * free
        some = np.flatnonzero(score)
        if len(some) > 64:  # the best are often enough
            least = np.partition(score[some], len(some) - 64)[len(some) - 64]
            best, some = some[score[some] >= least], some[score[some] < least]
            yield best[np.argsort(-score[best], kind="stable")]
        yield some[np.argsort(-score[some], kind="stable")]

    def neighbours(self, doc: int, free: np.ndarray) -> list[int]:
        return np.concatenate(list(self.ranked(doc, free))).tolist()


Piece = tuple[int, int, int]  # a document's number, where the piece starts, its length


def pack(sizes: list[int], index: Index, window: int, opened: list[Piece]) -> Iterator[list[Piece]]:
    """Full windows of documents that are each shorter than one; opened holds what is left over."""
    free = np.ones(len(sizes), np.int8)
    start, rest = [0] * len(sizes), np.array(sizes, np.int64)
    space = window - sum(x[2] for x in opened)
    cursor, seed = 0, -1

    def take(d: int, n: int) -> None:
        nonlocal space
        opened.append((d, start[d], n))
        start[d] += n
        rest[d] -= n
        space -= n
        if not rest[d]:
            free[d] = 0

    while True:
        if seed < 0 or not rest[seed]:
            while cursor < len(sizes) and not rest[cursor]:
                cursor += 1
            if cursor == len(sizes):
                return
            seed = cursor
        again = -1
        own = seed
        take(own, min(space, int(rest[own])))
        if space:
            partial = -1
            for order in index.ranked(own, free.copy()):
                left, at = rest[order], 0
                while space and len(fit := np.flatnonzero(left[at:] <= space)):
                    if fit[0] and partial < 0:
                        partial = int(order[at])  # the best that is too long
                    at += int(fit[0]) + 1
                    take(int(order[at - 1]), int(rest[order[at - 1]]))
                if not space:
                    break
                if partial < 0 and at < len(order):
                    partial = int(order[at])
            if space and partial >= 0:
                take(again := partial, space)
        elif rest[own]:
            again = own
        seed = again
        if not space:
            yield list(opened)
            opened.clear()
            space = window


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """An open window as sequences whose lengths are powers of two, longest first."""
    pieces = pieces[::-1]
    left = sum(x[2] for x in pieces)
    while left:
        size = room = 1 << left.bit_length() - 1
        out = []
        while room:
            d, at, n = pieces.pop()
            out.append((d, at, min(n, room)))
            if n > room:
                pieces.append((d, at + room, n - room))
            room -= min(n, room)
        left -= size
        yield out


def packed(docs: DataFrame, ranks: bytes, text: str = "text", keys: tuple[str, ...] = ("doc_id",), packing: Packing = Packing()) -> DataFrame:
    """The pieces: the key columns, start, length, ids (binary, four bytes each), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    added = added_tokens()
    size = max([len(ranks.split(b"\n")), *added.values()]) + 1
    window = packing.window
    tokens = stored(tokenized(docs, ranks, text, keys, window, added=added), "tokens")
    n_docs, n_rests, total = tokens.agg(F.count(F.lit(1)), F.count_if(F.col("rest") > 0), F.coalesce(F.sum("rest"), F.lit(0))).first()
    df = frequencies(tokens, size)
    idf = spark.sparkContext.broadcast(np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32))
    mean = total / max(1, n_rests)
    out = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), *fields("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")])

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, counter = 2 * TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for first in range(0, len(batch), 500):
                rows = []
                for row, raw, n in batch[["keys", "ids", "n"]].iloc[first : first + 500].itertuples(index=False):
                    ids = np.frombuffer(raw, "<u2").astype("<u4")
                    for at in range(0, n - n % window, window):
                        rows.append((row, at, window, ids[at : at + window].tobytes(), n, number | counter, 0))
                        counter += 1
                yield pd.DataFrame(rows, columns=out.names)

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 2 * TaskContext.get().partitionId() + 1 << 40
        counter, known, opened = 0, {}, []
        rows: list[tuple] = []  # at most a shard's tokens are held at a time

        def emit(pieces: list[Piece]) -> None:
            nonlocal counter
            offset = 0
            for d, at, n in pieces:
                row, base, ids = known[d]
                rows.append((row, base + at, n, ids[at : at + n].astype("<u4").tobytes(), base + len(ids), number | counter, offset))
                offset += n
            counter += 1

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=out.names)
            rows.clear()
            return made

        docs = [(row, base, np.frombuffer(raw, "<u2")) for batch in batches for row, base, raw in batch[["keys", "base", "ids"]].itertuples(index=False)]
        if not docs:
            return
        known.update(enumerate(docs))
        ids = [x[2] for x in docs]
        for pieces in pack([len(x) for x in ids], Index(ids, idf.value, mean, packing), window, opened):
            emit(pieces)
            if len(rows) > 1000:
                yield frame()
        for pieces in powers(opened):
            emit(pieces)
        yield frame()

    shards = max(1, -(-total // packing.shard_tokens))
    base = F.col("n") - F.col("rest")
    rests = tokens.where("rest > 0").select("keys", base.alias("base"), F.expr("substring(ids, cast(2 * (n - rest) + 1 as int), cast(2 * rest as int))").alias("ids"), "place", "salt", F.xxhash64("keys").alias("spread"))
    dealt = rests.repartitionByRange(shards, "place", "salt", "spread").sortWithinPartitions("place", "salt", "spread", "keys", "base")
    pieces = tokens.where(F.col("n") >= window).select("keys", "ids", "n").mapInPandas(whole, out).unionByName(dealt.select("keys", "base", "ids").mapInPandas(shard, out))
    kinds = dict(docs.select(*[f"`{c}`" for c in keys]).dtypes)
    return pieces.select(*[F.col("keys")[i].cast(kinds[c]).alias(c) for i, c in enumerate(keys)], *out.names[1:])


def rank_file(name: str = VOCABULARY) -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces, their ids as a checksum."""
    pieces = packed(docs.select("doc_id", "text"), rank_file())
    # ranges of shards are drawn anew by each evaluation: written once, all who read the result see the same sequences
    return stored(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"), "pieces")
