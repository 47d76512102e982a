"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text's words (lower-cased runs of letters and digits) give its k-mers of five words, each labelled with how often it has
occurred before. A sketch takes the two k-mers with the smallest hashes and keeps them in the order of the text, so that it responds
to edits and moves, not only to which k-mers there are. A sketch is a band; texts that agree in a band are candidates. A
candidate is a link if their edit similarity is at least 0.8: twice the length of the longest common subsequence of their words,
aligned within the band of diagonals that this similarity allows, by the words of both. Classes are the connected components.

Recall: where a share e of the words is replaced at random places, a share j = s / (2 - s) with s = (1 - e) ** 5 of the k-mers is
common, a band agrees with the chance j ** 2, and one of 96 with 1 - (1 - j ** 2) ** 96. Measured over random texts of 60 to 400 words:
of links of similarity 0.80 to 0.83 a band finds 0.97 where words are replaced and 0.91 where some are dropped or inserted; from 0.85 on
0.99 and more. Edits at every fifth word leave no common k-mer: words of five cannot find such a pair.

Candidates are worked off in rounds, so that neither a large group of copies nor a passage that many texts share costs all its pairs:

- Exact copies (equal words) are one text from the start, however many there are.
- A bucket (the texts that agree in a band) whose texts are all of one class is closed. One of at most `small` texts gives all its pairs
  of different classes, and is then closed.
- In a larger bucket each round one text, of a class chosen by hash, meets all texts of other classes; what it ties is contracted and leaves
  the bucket. A group of copies closes at once. The texts that no link ties to it choose their own among themselves; what is left after
  `rounds` is split by the texts' next sketches, each round again; a part that no sketch splits gives all its pairs. So most links are found at few pairs.
- At the end every larger bucket that still holds several classes is gone through whole: each two of its texts that are not of one class are compared by lengths and
  words without their order, in blocks of bounded size that are dealt over tasks, and aligned if these leave a link possible. The texts outside a bucket's largest class meet each other by the bucket; the largest
  class they meet once, in however many buckets they met it: a group of copies shares nearly all of its buckets, and its texts would else be read anew for each. There a pair must agree in a band.
  A text first meets the `nearest` of each other class by these words, as one link ties it to all of them; where there are more and no link has tied it by then, it meets the whole class.
  No two texts that agree in a band are left out, unless they are of one class already. The time of the blocks grows with the square of the texts of a bucket outside its largest class, memory does not.
- No pair is aligned twice. A pair whose lengths, or whose counts of words by 128 hash values, exclude the similarity is not aligned.

Defined results: a null text is an empty one, and all texts without words are copies of each other; a text of fewer than five
words is one k-mer of all its words; very long texts are read and aligned whole (in the band of diagonals); a class is named by its
smallest document id (null only if all are null), and that document is kept, once if its row is repeated; an empty table gives an
empty result. Other columns, whatever their names, are not touched.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, fields, settings, stored, table, text_of

WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Elements of a table of permuted labels that are made at a time.
AT_ONCE = 4_000_000


@dataclass(frozen=True)
class Near:
    """words: of a k-mer. picks: k-mers of a sketch. rows: sketches of a band. small: texts of a bucket up to which all its pairs are made. rounds: texts of a larger bucket that meet all its others before it is split.
    bins: hash values that words are counted by. block: texts of a side of the blocks in which a larger bucket is gone through. block_words: words of such a text, on average, up to which blocks have that many. nearest: texts of a class that another text meets in them before it meets all. texts_at_once, pairs_at_once: rows that a Python worker gets at a time. broadcast_keys: keys of texts (five numbers each) up to which they are broadcast."""

    words: int = 5
    similarity: float = 0.8
    picks: int = 2
    rows: int = 1
    bands: int = 96
    small: int = 16
    rounds: int = 2
    bins: int = 128
    block: int = 1024
    block_words: int = 512
    nearest: int = 4
    texts_at_once: int = 2000
    pairs_at_once: int = 128
    broadcast_keys: int = 500_000
    seed: int = 20240229


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def kmers(words: np.ndarray, k: int) -> np.ndarray:
    n = max(1, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, len(words))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
    return out


def labelled(found: np.ndarray) -> np.ndarray:
    """Each k-mer with its number among its equals before it."""
    order = np.argsort(found, kind="stable")
    ordered = found[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    if len(starts) == len(found):
        return found
    nth = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
    out = np.empty_like(found)
    out[order] = nth.astype(np.uint64)
    return np.where(out > 0, mixed(found + out * np.uint64(0xC2B2AE3D27D4EB4F)), found)  # the first as in texts that have none twice


@functools.lru_cache(4)
def permutations(seed: int, n: int) -> np.ndarray:
    turn = np.random.default_rng(seed).integers(0, 2**32, (2, n), np.uint32)
    turn[1] |= np.uint32(1)
    return turn


def sketches(labels: np.ndarray, near: Near) -> np.ndarray:
    """One hash for each band."""
    m, picks = near.bands * near.rows, min(near.picks, len(labels))
    turn = permutations(near.seed, m)
    short = (labels >> np.uint64(32)).astype(np.uint32)
    each = max(1, AT_ONCE // len(labels))
    places = np.empty((m, picks), np.int64)
    for at in range(0, m, each):
        values = (short[None, :] ^ turn[0, at : at + each, None]) * turn[1, at : at + each, None]
        rows = np.arange(len(values))
        for i in range(picks):
            places[at : at + each, i] = least = values.argmin(axis=1)
            values[rows, least] = 0xFFFFFFFF
    places.sort(axis=1)  # the order of the text
    out = np.zeros(m, np.uint64)
    for chosen in labels[places].T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + chosen)
    band = np.arange(near.bands, dtype=np.uint64)
    for row in out.reshape(near.bands, near.rows).T:
        band = mixed(band * np.uint64(0xC2B2AE3D27D4EB4F) + row)
    return band.view(np.int64)


def tally(words: np.ndarray, bins: int) -> bytes:
    """How many words have each hash value, up to 255."""
    return np.minimum(np.bincount((words % np.uint64(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8).tobytes()


def common(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence of a and b whose matches lie at most `band` diagonals from the main one, by the bit-parallel recurrence; a row holds the bits of its band only."""
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    masks = {x: functools.reduce(lambda s, p: s | 1 << p, at, 0) for x, at in where.items() if len(at) > 8}
    width = 2 * band + 1
    top, full = 1 << width - 1, (1 << width) - 1
    row, length, low = full, 0, -band
    for j, x in enumerate(b):
        if j:
            length += not row & 1
            row = row >> 1 | top
            low += 1
        if (at := where.get(x)) is not None:
            if len(at) > 8:
                mask = (masks[x] >> low if low >= 0 else masks[x] << -low) & full
            else:
                mask = 0
                for p in at:
                    if 0 <= p - low < width:
                        mask |= 1 << p - low
            if mask and (hit := row & mask):
                row = (row + hit | row - hit) & full
    return length + width - row.bit_count()


def alignment(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether twice the words that the best alignment has in common are at least this share of the words of both texts."""
    n = len(a) + len(b)
    need = int(np.ceil(similarity * n / 2 - 1e-9))
    if need > min(len(a), len(b)):
        return False
    if not n:
        return True
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if np.minimum(nx[i], ny[j]).sum() < need:  # fewer in common even without their order
        return False
    short = min(len(a), len(b))
    unlike = np.flatnonzero(a[:short] != b[:short])
    head = int(unlike[0]) if len(unlike) else short
    unlike = np.flatnonzero(a[len(a) - (short - head) :] != b[len(b) - (short - head) :])
    tail = short - head - 1 - int(unlike[-1]) if len(unlike) else short - head
    return head + tail + common(a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist(), n - 2 * need) >= need


def sketching(near: Near):
    @F.pandas_udf(fields("key binary, n long, bands longs, tally binary"))
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = word_hashes(text)
                found = kmers(words, near.words)
                rows.append((xxhash.xxh3_128_digest(words.tobytes()), len(words), sketches(labelled(found), near), tally(words, near.bins)))
            yield pd.DataFrame(rows, columns=["key", "n", "bands", "tally"])

    return sketch


def plausible(near: Near):
    """Whether the counts of words leave the similarity possible: texts with that many words in common differ in no more than the rest, and counts by hash value differ by no more than the words do."""

    @F.pandas_udf("boolean")
    def possible(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, near.bins).astype(np.int16) for s in (a, b))
        return pd.Series(np.abs(x - y).sum(axis=1) <= (1 - near.similarity) * n.to_numpy() + 1e-6)

    return possible


def verifying(near: Near):
    @F.pandas_udf("boolean")
    def verified(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        @functools.lru_cache(64)
        def of(text: str) -> np.ndarray:
            return word_hashes(text)

        for a, b in batches:
            yield pd.Series([alignment(of(x), of(y), near.similarity) for x, y in zip(a, b, strict=True)])

    return verified


def text_key(text: str | Column) -> Column:
    text = text_of(text)
    return F.struct(F.xxhash64(text).alias("x"), F.hash(text).alias("h"), F.length(text).alias("n"))


def open_buckets(members: DataFrame, near: Near, turn: int) -> DataFrame:
    """members (bucket, id, n, depth, turns, label) of the buckets that hold several labels, with size, whole (all pairs are made) and hub (this turn's text)."""
    # the class by its label, so that the same text is chosen in most buckets of a group
    chosen = F.min(F.struct(F.xxhash64("label", F.lit(turn)).alias("c"), F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n", "label"))
    whole = (F.count(F.lit(1)) <= near.small) | (F.max("depth") >= near.bands)
    shape = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), whole.alias("whole"), F.min("label").alias("x"), F.max("label").alias("y"), chosen.alias("hub")).where("x <> y")
    return members.join(shape.select("bucket", "size", "whole", F.struct("hub.id", "hub.n", "hub.label").alias("hub")), "bucket")


def pairs_of(opened: DataFrame, near: Near) -> DataFrame:
    """Different pairs a < b (ids) of one bucket, of different labels and of lengths that allow a link: all of a whole bucket, and those with the hub of another one."""
    listed = opened.where("whole").groupBy("bucket").agg(F.collect_list(F.struct("id", "n", "label")).alias("all"))
    small = listed.select(F.explode("all").alias("a"), "all").select("a", F.explode(F.filter("all", lambda b: (b["id"] > F.col("a.id")) & (b["label"] != F.col("a.label")))).alias("b"))
    large = opened.where(~F.col("whole")).select(F.struct("id", "n", "label").alias("a"), F.struct("hub.id", "hub.n", "hub.label").alias("b")).where("a.label <> b.label")
    fit = 2 * F.least("a.n", "b.n") >= near.similarity * (F.col("a.n") + F.col("b.n"))  # else too unlike in length
    return small.unionByName(large).where(fit).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def word_sets(near: Near):
    """A text's words, each with its number among its equals before it, as sorted hashes of 32 bits: texts have as many of these in common, at least, as they have words."""

    @F.pandas_udf("binary")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: np.sort((labelled(word_hashes(text)) >> np.uint64(32)).astype(np.uint32)).tobytes())

    return words


def possible_pairs(near: Near, most: int):
    """Pairs of a block that may be links by their words without their order, and agree in a band if bands are given; of each text and other class the `most` nearest (0: all). first: whether a row is of the first side (null: of both). Two texts of the same sides meet once, by their ids; a text of the second side whose label is main meets all of the first. more: whether the text has others of that label."""

    def in_common(side: pd.DataFrame):
        held = [np.frombuffer(w, np.uint32) for w in side["words"]]
        terms, owner = np.concatenate([np.empty(0, np.uint32), *held]), np.repeat(np.arange(len(held)), [len(w) for w in held])
        order = np.argsort(terms, kind="stable")
        terms, owner = terms[order], owner[order]

        def counts(words: np.ndarray) -> np.ndarray:
            at, sizes = np.searchsorted(terms, words), np.searchsorted(terms, words, side="right")
            sizes -= at
            every = np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            return np.bincount(owner[every], minlength=len(held))

        return counts

    def pairs(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("n", kind="stable")
        first, second = block[block["first"].ne(False)], block[block["first"].ne(True)]
        ids, n, labels, main = (second[c].to_numpy() for c in ("id", "n", "label", "main"))
        x, y = (np.frombuffer(b"".join(side["tally"]), np.uint8).reshape(-1, near.bins) for side in (first, second))
        banded = "bands" in block and block["bands"].notna().all()
        us, them = (np.stack(side["bands"]) if banded and len(side) else None for side in (first, second))
        ratio, found, counts = near.similarity / (2 - near.similarity), [], None
        for i, (id, size, label, words) in enumerate(first[["id", "n", "label", "words"]].itertuples(index=False)):
            low, high = np.searchsorted(n, size * ratio - 1e-6), np.searchsorted(n, size / ratio + 1e-6, side="right")
            some = low + np.flatnonzero((labels[low:high] != label) & ((labels[low:high] == main[low:high]) | (ids[low:high] > id)))
            apart = (np.maximum(x[i], y[some]) - np.minimum(x[i], y[some])).sum(axis=1, dtype=np.int64)
            some = some[apart <= (1 - near.similarity) * (size + n[some]) + 1e-6]
            if not len(some):
                continue
            counts = counts or in_common(second)
            both = size + n[some]
            apart = both - 2 * counts(np.frombuffer(words, np.uint32))[some]
            fit = apart <= (1 - near.similarity) * both + 1e-6
            some, apart = some[fit], (apart / np.maximum(1, both))[fit]
            if banded:
                agree = (them[some] == us[i]).any(axis=1)
                some, apart = some[agree], apart[agree]
            more = np.zeros(len(some), bool)
            if most and len(some) > most:
                order = np.lexsort((ids[some], apart, labels[some]))
                ordered = labels[some[order]]
                starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
                nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
                beyond = labels[some[order[nth >= most]]]
                some = some[order[nth < most]]
                more = np.isin(labels[some], beyond)
            found.append(np.stack([np.minimum(id, ids[some]), np.maximum(id, ids[some]), np.full(len(some), id), labels[some], more]))
        return pd.DataFrame(np.concatenate([np.empty((5, 0), np.int64), *found], axis=1).T, columns=["a", "b", "text", "label", "more"]).astype({"more": bool})

    return pairs


def by_bucket(members: DataFrame, near: Near) -> DataFrame:
    """bucket, id, n, label of the members of buckets that hold several labels, with labels (how many), main (the largest class) and the number of parts of the texts outside it."""
    counted = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
    counted = counted.groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"), F.sum("size").alias("size"), F.sum("n").alias("words"), F.max(F.struct("size", "label", "n")).alias("most")).where("labels > 1")
    shape = counted.select("bucket", "labels", F.col("most.label").alias("main"), blocks(F.col("size") - F.col("most.size"), F.col("words") - F.col("most.n"), near).alias("parts"))
    return members.join(shape, "bucket")


def blocks(texts: Column, n: Column, near: Near) -> Column:
    """Parts of a side, which hold at most so many texts, and words, on average."""
    return F.greatest(F.lit(1), F.ceil(texts / near.block), F.ceil(n / (near.block * near.block_words)))


def pairs_left(among: DataFrame | None, against: DataFrame, words: DataFrame, near: Near, most: int) -> DataFrame:
    """Different pairs a < b (ids) of different labels whose words leave a link possible: of the texts of a bucket (among), and of those that meet a class with the class (against), where they agree in a band. Of each text and other label these are the `most` nearest of a block (0: all); more: whether text has others of that label."""
    part = lambda of: F.pmod(F.xxhash64("id"), F.col(of))
    every = lambda of: F.sequence(F.lit(0).cast("long"), F.col(of) - 1)
    sides = against.groupBy("class").pivot("first", [True, False]).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n")).where("true_size > 0 and false_size > 0")
    sides = sides.select("class", blocks(F.col("true_size"), F.col("true_n"), near).alias("parts"), blocks(F.col("false_size"), F.col("false_n"), near).alias("others"))
    met = against.join(sides, "class")
    # a text of the first side meets all parts of the other
    other = F.transform(F.when(F.col("first"), every("others")).otherwise(every("parts")), lambda x: F.when(F.col("first"), F.struct(part("parts").alias("part"), x.alias("other"), F.lit(True).alias("first"))).otherwise(F.struct(x.alias("part"), part("others").alias("other"), F.lit(False).alias("first"))))
    rows = met.select(F.col("class").alias("at"), F.lit(True).alias("by_class"), F.col("class").alias("main"), "id", "n", "label", other.alias("dealt"))
    if among is not None:
        # each two parts of a bucket meet once, and each part meets itself
        two = F.transform(every("parts"), lambda x: F.struct(F.least(part("parts"), x).alias("part"), F.greatest(part("parts"), x).alias("other"), F.when(part("parts") != x, part("parts") < x).alias("first")))
        rows = rows.unionByName(among.select(F.col("bucket").alias("at"), F.lit(False).alias("by_class"), "main", "id", "n", "label", two.alias("dealt")))
    rows = rows.join(words, "id").withColumn("bands", F.when(F.col("by_class"), F.col("bands"))).withColumn("d", F.explode("dealt"))
    main = F.when(F.col("d.first").eqNullSafe(False), F.col("label")).otherwise(F.col("main")).alias("main")  # two parts have no text in common
    rows = rows.select("at", "by_class", "d.part", "d.other", "d.first", "id", "n", "label", main, "tally", "words", "bands")
    return rows.groupBy("at", "by_class", "part", "other").applyInPandas(possible_pairs(near, most), fields("a long, b long, text long, label long, more boolean"))


def kinds_of(ids: DataFrame, reps: DataFrame, near: Near, *columns: str) -> DataFrame:
    """id and columns of the texts with these ids, repeated or not."""
    wanted = cut(ids.distinct())
    if wanted.count() <= near.broadcast_keys:  # else all texts are dealt by their ids
        wanted = F.broadcast(wanted)
    return cut(reps.select("id", *columns).join(wanted, "id"))


def texts_of(ids: DataFrame, reps: DataFrame, source: DataFrame, near: Near) -> DataFrame:
    """id, text of these ids, repeated or not."""
    wanted = cut(ids.distinct().join(reps.select("id", "t"), "id"))
    if wanted.count() <= near.broadcast_keys:  # else the texts are dealt by their keys
        wanted = F.broadcast(wanted)
    return stored(source.select("t", "text").join(wanted, "t").groupBy("id").agg(F.first("text").alias("text")), "texts")


def links_of(pairs: DataFrame, reps: DataFrame, source: DataFrame, near: Near) -> DataFrame:
    """The pairs of ids that the alignment confirms."""
    both = lambda of: of.select(F.col("a").alias("id")).union(of.select("b"))
    held = kinds_of(both(pairs), reps, near, "n", "t", "tally")
    a, b = (held.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("tally").alias(f"t{x}")) for x in "ab")
    likely = cut(pairs.join(a, "a").join(b, "b").where(plausible(near)("ta", "tb", F.col("na") + F.col("nb"))).select("a", "b"))
    texts = texts_of(both(likely), held, source, near)
    a, b = (texts.select(F.col("id").alias(x), F.col("text").alias(f"w{x}")) for x in "ab")
    with settings(pairs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(near.pairs_at_once)}):  # two whole texts a row
        return cut(likely.join(a, "a").join(b, "b").where(verifying(near)("wa", "wb")).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """key, label: one key of its component, the same for all. Each round every key points at its smallest neighbour, or at what that one points at; links are then drawn between what their ends point at, and those within one are gone."""
    links, named = links.select("a", "b"), None
    while True:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("label"))
        least = cut(least.join(least.select(F.col("key").alias("label"), F.col("label").alias("to")), "label").select("key", F.col("to").alias("label")))
        named = least if named is None else named.join(least.select(F.col("key").alias("label"), F.col("label").alias("to")), "label", "left").select("key", F.coalesce("to", "label").alias("label"))
        a, b = least.select(F.col("key").alias("a"), F.col("label").alias("x")), least.select(F.col("key").alias("b"), F.col("label").alias("y"))
        links = cut(links.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if links.isEmpty():
            return cut(named)


def with_labels(frame: DataFrame, labels: DataFrame | None, id: str = "id", label: str = "label") -> DataFrame:
    """frame with the label of each id: the id itself if nothing has tied it."""
    if labels is None:
        return frame.withColumn(label, F.col(id))
    found = labels.select(F.col("id").alias(id), F.col("label").alias("found_"))
    return frame.join(found, id, "left").withColumn(label, F.coalesce("found_", id)).drop("found_")


def labelled_members(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """members with their labels, looked up once for a text and not for each of its buckets."""
    if labels is None:
        return with_labels(members, None)
    held = members.groupBy("id").agg(F.collect_list(F.struct("bucket", "n", "depth", "turns")).alias("held"))  # at most one bucket for each band
    return with_labels(held, labels).select("id", "label", F.explode("held").alias("m")).select("m.bucket", "id", "m.n", "m.depth", "m.turns", "label")


def joined_by(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: the components of what these tie are worked on, not those of all texts."""
    edges = with_labels(with_labels(links, labels, "a", "x"), labels, "b", "y").where("x <> y")
    tied = components(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if labels is None:
        return tied.select(F.col("key").alias("id"), "label")
    moved = labels.join(tied.select(F.col("key").alias("label"), F.col("label").alias("to")), "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    return cut(moved.unionByName(tied.select(F.col("key").alias("id"), "label").join(labels.select("id"), "id", "left_anti")))


def untied(opened: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of larger buckets that are not of their hub's class now. They are told by pairs of text and hub, which are far fewer than the buckets in which they met."""
    met = opened.select("id", F.col("hub.id").alias("hub_id")).where("id <> hub_id").distinct()
    apart = with_labels(with_labels(met, labels, "id", "x"), labels, "hub_id", "y").where("x <> y").select("id", "hub_id")
    narrow = opened.select("bucket", "id", "n", "depth", "turns", "size", F.col("hub.id").alias("hub_id")).where("id <> hub_id")
    return narrow.join(apart, ["id", "hub_id"], "left_semi").drop("hub_id")


def split(members: DataFrame, reps: DataFrame, near: Near) -> DataFrame:
    """The buckets' members by their next two sketches, or by three or four where the bucket is large; which come next is chosen by the bucket's hash. A part of one text has no pair and goes."""
    more = 2 + (F.col("size") > 4 * near.small).cast("int") + (F.col("size") > 16 * near.small).cast("int")
    start = (F.pmod(F.xxhash64("bucket"), F.lit(near.bands)) + 1).cast("int")
    found = members.withColumn("more", more).join(kinds_of(members.select("id"), reps, near, "bands"), "id")
    found = found.withColumn("bucket", F.xxhash64("bucket", F.slice(F.concat("bands", "bands"), start, F.col("more"))))
    parts = cut(found.select("bucket", "id", "n", (F.col("depth") + F.col("more")).alias("depth"), F.lit(near.rounds - 1).alias("turns")))
    several = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    return parts.join(several, "bucket", "left_semi").select(*parts.columns)


def tied_texts(reps: DataFrame, source: DataFrame, near: Near) -> DataFrame | None:
    """id, label of the texts that some link ties; None if there is no link. reps: id, n, t, bands, tally; source: t, text."""
    buckets = reps.select("id", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = cut(buckets.join(shared.hint("shuffle_hash"), "bucket").select("bucket", "id", "n", F.lit(1).alias("depth"), F.lit(0).alias("turns"), "size"))
    members, large = met.drop("size"), met.where(F.col("size") > near.small).drop("size")
    labels, tested, turn = None, None, 0
    while not members.isEmpty():
        opened = cut(open_buckets(labelled_members(members, labels), near, turn))
        pairs = pairs_of(opened, near)
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs if tested is None else cut(tested.unionByName(pairs))
        if not pairs.isEmpty():
            links = links_of(pairs, reps, source, near)
            labels = labels if links.isEmpty() else joined_by(labels, links)
        left = cut(untied(opened.where(~F.col("whole")), labels).withColumn("turns", F.col("turns") + 1))
        if not turn:  # the others are of their hub's class, and stay so
            large = cut(large.join(left.select("bucket").distinct(), "bucket", "left_semi"))
        members, over, turn = left.where(F.col("turns") < near.rounds).select("bucket", "id", "n", "depth", "turns"), left.where(F.col("turns") >= near.rounds), turn + 1
        if not over.isEmpty():
            members = cut(members.unionByName(split(over, reps, near)))
    return labels if large.isEmpty() else tied_in_blocks(large, labels, tested, reps, source, near)


def tied_in_blocks(large: DataFrame, labels: DataFrame | None, tested: DataFrame, reps: DataFrame, source: DataFrame, near: Near) -> DataFrame | None:
    """labels after the larger buckets that still hold several have been gone through whole. tested: pairs that were aligned before."""
    members = cut(with_labels(large.select("bucket", "id", "n"), labels))  # written, as it is read twice
    held = cut(by_bucket(members, near))
    if held.isEmpty():
        return labels
    among = held.where("label <> main and labels > 2").select("bucket", "main", "parts", "id", "n", "label")  # these meet each other, and once their buckets' classes
    against = cut(held.select(F.col("main").alias("class"), (F.col("label") != F.col("main")).alias("first"), "id", "n", "label").distinct())
    texts = texts_of(held.select("id"), reps, source, near).select("id", word_sets(near)("text").alias("words"))
    words = stored(texts.join(kinds_of(held.select("id"), reps, near, "tally", "bands"), "id"), "words")
    for most in (near.nearest, 0):
        found = cut(pairs_left(among, against, words, near, most))
        pairs = cut(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            tested = cut(tested.unionByName(pairs))
            links = links_of(pairs, reps, source, near)
            labels = labels if links.isEmpty() else joined_by(labels, links)
        # these meet the whole class: a label is a text, so that it tells by its own label whether a link has tied it
        met = found.where("more").select("text", F.col("label").alias("class")).distinct()
        left = cut(with_labels(with_labels(met, labels, "text", "x"), labels, "class", "y").where("x <> y").select(F.col("text").alias("id"), "class"))
        if left.isEmpty():
            break
        texts = held.select("id", "n", "label").distinct()
        second = texts.join(left.select(F.col("class").alias("label")).distinct(), "label", "left_semi").select(F.col("label").alias("class"), F.lit(False).alias("first"), "id", "n", "label")
        among, against = None, cut(texts.join(left, "id").select("class", F.lit(True).alias("first"), "id", "n", "label").unionByName(second))
    return labels


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """For each row: id, t (a key of its text), class_id, class_size (rows), kept (whether it is the document that stays)."""
    source = docs.select(F.col(f"`{id}`").alias("id"), text_of(F.col(f"`{text}`")).alias("text")).withColumn("t", text_key("text"))
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(near.texts_at_once)}):
        rows = stored(source.select("id", "t", sketching(near)("text").alias("s")).select("id", "t", "s.*"), "sketches")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "t")
    reps = rows.groupBy("key").agg(F.min("t").alias("t"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("tally").alias("tally"), F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
    reps = stored(reps.withColumn("id", F.monotonically_increasing_id()), "kinds")  # written, so that the numbers stay
    labels = tied_texts(reps, source, near)

    named = reps.select("id", "key", "first", F.col("copies").alias("class_size"))
    lone = named if labels is None else named.join(labels.select("id"), "id", "left_anti")
    winners = lone.select("key", F.col("first").alias("winner"), "class_size")
    if labels is not None:
        tied = cut(named.join(labels, "id"))
        # with both sides of the join dealt by the label alone, a class of many texts can be split over tasks
        best = cut(tied.groupBy("label").agg(F.min("first").alias("winner"), F.sum("class_size").alias("class_size")))
        winners = winners.unionByName(tied.select("key", "label").join(best, "label").select("key", "winner", "class_size"))
    joined = rows.select("id", "t", "key").join(winners, "key")
    kept = F.col("id").eqNullSafe(F.col("winner.id")) & (F.col("t") == F.col("winner.t"))
    return joined.select("id", "t", F.col("winner.id").alias("class_id"), "class_size", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """docs with one row of each class. Rows that repeat the kept document's id and text give the least of them, by their columns in order."""
    found = classes(docs, id, text, near)
    marks = cut(found.groupBy("id", "t").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("kept")).where("n > 1 or not kept"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    marks = marks.select(F.col("id").alias("mark_id"), F.col("t").alias("mark_t"), "kept")
    if marks.count() <= near.broadcast_keys:  # else whole documents are dealt by id and text
        marks = F.broadcast(marks)
    marked = whole.join(marks, F.col("doc").getField(id).eqNullSafe(F.col("mark_id")) & (text_key(F.col("doc").getField(text)) == F.col("mark_t")), "left")
    stay = marked.where(F.col("kept").isNull()).select("doc.*")
    if marks.where("kept").isEmpty():
        return stay
    return stay.unionByName(marked.where("kept").groupBy("mark_id", "mark_t").agg(F.min("doc").alias("doc")).select("doc.*"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)
