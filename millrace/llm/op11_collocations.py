"""Phrase collocation mining: sketches propose phrases, automata count them, and only exact counts decide.

Four passes over the texts, each a scan without a shuffle of text:

1. words are counted exactly for each language;
2. every phrase of two to five frequent words is added to a count-min sketch of a fixed number of cells for the table, whose cells are never
   below the true count; the sums of all tasks, cut to one bit a cell (bound reached or not), are small whatever the corpus;
3. phrases whose own upper bound and those of the phrases inside them reach the threshold are candidates, each written once;
4. candidates, in shards of a bounded number of phrases, are compiled into one automaton for each language. A phrase is held with a delimiter
   on both sides (" of the "), and texts are joined by single delimiters, so that matches are whole words and may overlap; a line feed, which is
   no part of any word, parts the pieces. Every shard scans all texts; matches are counted in the tasks and then summed.

Thresholds, cuts, scores and the test for longer phrases are joins and sums of exact counts. The sketch can only propose too much, never too
little: its size changes the work, not the result. What is broadcast is bounded: a bit for each cell of the filters (at most `max_cells`), and a shard of phrases.

Texts are handled as UTF-8 bytes: delimiters are ASCII, so that no character is ever cut.

Defined results: a null text is empty, a null language is `und`; a text without words counts nothing; texts of any length are counted
whole (a task holds one text, or some megabytes of shorter ones, at a time); repeated rows count as often as they occur; equal scores go by count and then by the bytes
of the phrase; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from operator import itemgetter

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import cut, fields, stored, table, text_of

DELIMITERS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
PLAIN = bytes.maketrans(UPPER + DELIMITERS + b"\t", LOWER + b"\n" * len(DELIMITERS) + b" ")
CHUNK = 1 << 21
#: Cells of a sketch, phrases of an automaton, and lists of candidates for each language, that travel together.
BLOCK, PHRASES, PARTS = 1 << 16, 1 << 12, 256
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass(frozen=True)
class Mining:
    """min_count: least occurrences of a candidate. longest: words of a phrase. contained: percentage of a phrase's count at which a longer one takes its place.
    top: rows for a language. words_per_cell: words of the corpus for each cell of the sketch, between min_cells and max_cells. shard: phrases of an automaton pass."""

    min_count: int = 100
    longest: int = 5
    contained: int = 100
    top: int = 2000
    words_per_cell: int = 8
    min_cells: int = 1 << 20
    max_cells: int = 1 << 27
    shard: int = 500_000


def plain(text: str) -> bytes:
    """The text in lower case, with line feeds where pieces part and spaces between words."""
    return text.encode("utf-8", "surrogatepass").translate(PLAIN)


def chunks(batch: pd.DataFrame) -> Iterator[tuple[str, bytes]]:
    """Texts of a language joined by line feeds, some megabytes at a time."""
    for lang, texts in batch.groupby("lang", sort=False)["text"]:
        held, size = [], 0
        for text in texts:
            held.append(plain(text))
            size += len(held[-1]) + 1
            if size >= CHUNK:
                yield lang, b"\n".join(held)
                held, size = [], 0
        if held:
            yield lang, b"\n".join(held)


class Words:
    """Hashes of the words of a buffer, their places in it, and the piece that each is in."""

    _letters = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    _powers = _inverses = np.ones(1, np.uint64)

    @classmethod
    def _reach(cls, n: int) -> None:
        if len(cls._powers) < n:
            size = max(n, CHUNK + (1 << 16))
            base = 0x5851F42D4C957F2D
            cls._powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            cls._inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, pow(base, -1, 1 << 64), np.uint64)]))

    def __init__(self, lang: str, buffer: bytes) -> None:
        raw = np.frombuffer(buffer, np.uint8)
        self._reach(len(raw) + 1)
        line = raw == 10
        edge = np.concatenate([[True], line | (raw == 32), [True]])
        self.starts = np.flatnonzero(edge[:-1] & ~edge[1:])
        self.ends = np.flatnonzero(~edge[:-1] & edge[1:])
        self.piece = np.cumsum(line, dtype=np.int32)[self.starts] if len(raw) else np.zeros(0, np.int32)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._letters[raw] * self._powers[: len(raw)])])
        salt = np.uint64(int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * self._inverses[self.starts] + (self.ends - self.starts).astype(np.uint64) + salt)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * ODD[0]
    return h ^ h >> np.uint64(29)


def longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return mixed(h * ODD[1] + last)


def cells_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A cell in each of the two rows of a sketch with 2**bits cells in all."""
    shift, half = np.uint64(65 - bits), 1 << bits - 1
    return (h >> shift).astype(np.int64), ((h * ODD[3]) >> shift).astype(np.int64) + half


class Bits:
    """One bit for each cell: whether its bound is reached."""

    def __init__(self, packed: np.ndarray, bits: int) -> None:
        self.packed, self.bits = packed, bits

    def reached(self, h: np.ndarray) -> np.ndarray:
        one, two = ((self.packed[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 for c in cells_of(h, self.bits))
        return (one & two).astype(bool)


def blocks(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Cells of one byte in blocks that have any."""
    pack = zstandard.ZstdCompressor(level=1)
    for i in range(0, len(cells), BLOCK):
        if cells[i : i + BLOCK].any():
            yield i // BLOCK, pack.compress(cells[i : i + BLOCK].tobytes())


def bounded(parts: DataFrame, bits: int, least: int) -> Bits:
    """Sums the tasks' cells block by block; one bit for each comes to the driver, 2**bits of them in all."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for block, raw in zip(batch["block"], batch["cells"], strict=True):
                some = np.frombuffer(unpack.decompress(raw, BLOCK), np.uint8)
                held = sums.setdefault(block, np.zeros(len(some), np.uint16))
                held += np.minimum(some, least - np.minimum(held, least))  # never above the bound
        if sums:
            yield pd.DataFrame([(k, np.packbits(v >= least).tobytes()) for k, v in sums.items()], columns=["block", "cells"])

    out = np.zeros(1 << bits - 3, np.uint8)
    for row in parts.repartition("block").mapInPandas(total, fields("block int, cells binary")).toLocalIterator():
        some = np.frombuffer(row["cells"], np.uint8)
        out[row["block"] * BLOCK >> 3 :][: len(some)] = some
    return Bits(out, bits)


def texts_of(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), text_of(F.col(f"`{text}`")).alias("text"))


def counted_words(texts: DataFrame) -> DataFrame:
    """lang, word, f; and for each language a row with a null word and the number of all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def frames() -> Iterator[pd.DataFrame]:
            for lang, found in held.items():
                words = [(w.decode("utf-8", "surrogatepass"), n) for w, n in found.items()]
                for i in range(0, len(words), 100_000):
                    yield pd.DataFrame([(lang, *x) for x in words[i : i + 100_000]], columns=["lang", "word", "f"])
                yield pd.DataFrame([(lang, None, found.total())], columns=["lang", "word", "f"])
            held.clear()

        for batch in batches:
            for lang, buffer in chunks(batch):
                held.setdefault(lang, Counter()).update(buffer.translate(FLAT).split(b" "))
                held[lang].pop(b"", None)
            if sum(map(len, held.values())) > 1_000_000:
                yield from frames()
        yield from frames()

    return texts.mapInPandas(count, fields("lang string, word string, f long")).groupBy("lang", "word").agg(F.sum("f").alias("f"))


FLAT = bytes.maketrans(b"\n", b" ")


def word_filter(words: DataFrame, bits: int) -> Bits:
    """A bit for each frequent word's cells."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            for lang, some in batch.groupby("lang", sort=False)["word"]:
                for i in range(0, len(some), 50_000):
                    for c in cells_of(Words(lang, b"\n".join(w.encode("utf-8", "surrogatepass") for w in some.iloc[i : i + 50_000])).hashes, bits):
                        cells[c] = 1
        yield pd.DataFrame(blocks(cells), columns=["block", "cells"])

    return bounded(words.select("lang", "word").mapInPandas(mark, fields("block int, cells binary")), bits, 1)


def sketch(texts: DataFrame, words: Bits, bits: int, mining: Mining) -> Bits:
    """Upper bounds of the counts of all phrases of frequent words, as whether they reach the threshold."""
    shared, least = texts.sparkSession.sparkContext.broadcast(words), min(mining.min_count, 255)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, one = np.zeros(1 << bits, np.uint32), np.uint32(1)
        for batch in batches:
            for lang, buffer in chunks(batch):
                w = Words(lang, buffer)
                h, at = w.hashes, np.flatnonzero(shared.value.reached(w.hashes))
                good, h = np.zeros(len(h) + mining.longest, bool), h[at]
                good[at] = True
                for k in range(2, mining.longest + 1):
                    on = good[at + k - 1]
                    at, h = at[on], h[on]
                    on = w.piece[at] == w.piece[at + k - 1]
                    at, h = at[on], h[on]
                    h = longer(h, w.hashes[at + k - 1])
                    for c in cells_of(h, bits):
                        np.add.at(cells, c, one)
        yield pd.DataFrame(blocks(np.minimum(cells, least).astype(np.uint8)), columns=["block", "cells"])

    return bounded(texts.mapInPandas(add, fields("block int, cells binary")), bits, least)


def candidates(texts: DataFrame, words: Bits, bounds: Bits, mining: Mining) -> DataFrame:
    """lang, phrase: each phrase once whose upper bound, and those of the phrases inside it, reach the threshold."""
    shared = texts.sparkSession.sparkContext.broadcast((words, bounds))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bounds = shared.value
        seen: set[int] = set()
        found: dict[tuple[str, int], list[bytes]] = {}

        def frame() -> pd.DataFrame:
            pack = zstandard.ZstdCompressor(level=1)
            made = pd.DataFrame([(lang, part, pack.compress(b"\n".join(sorted(some)))) for (lang, part), some in found.items()], columns=["lang", "part", "phrases"])
            seen.clear()
            found.clear()
            return made

        for batch in batches:
            for lang, buffer in chunks(batch):
                w = Words(lang, buffer)
                good, h, at = np.zeros(len(w.hashes) + 1, bool), w.hashes, np.flatnonzero(words.reached(w.hashes))
                h = h[at]
                good[at] = True
                for k in range(2, mining.longest + 1):
                    on = good[at + 1]  # what starts one word later has reached its bound, too
                    at, h = at[on], h[on]
                    on = w.piece[at] == w.piece[at + k - 1]
                    at, h = at[on], h[on]
                    h = longer(h, w.hashes[at + k - 1])
                    on = bounds.reached(h)
                    at, h = at[on], h[on]
                    good[:] = False
                    good[at] = True
                    fresh, first = np.unique(h, return_index=True)
                    for key, i in zip(fresh.tolist(), at[first].tolist(), strict=True):
                        if key not in seen:
                            seen.add(key)
                            phrase = b" ".join(buffer[a:b] for a, b in zip(w.starts[i : i + k].tolist(), w.ends[i : i + k].tolist(), strict=True))
                            found.setdefault((lang, key % PARTS), []).append(phrase)
            if len(seen) > 1_000_000:
                yield frame()
        yield frame()

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, held = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for lang, raw in zip(batch["lang"], batch["phrases"], strict=True):
                held.setdefault(lang, set()).update(unpack.decompress(raw).split(b"\n"))
        for lang, some in held.items():
            rows = [x.decode("utf-8", "surrogatepass") for x in some]
            for i in range(0, len(rows), 100_000):
                yield pd.DataFrame({"lang": lang, "phrase": rows[i : i + 100_000]})

    # phrases travel in compressed lists, a task's own met already
    return texts.mapInPandas(find, fields("lang string, part int, phrases binary")).repartition("lang", "part").mapInPandas(meet, fields("lang string, phrase string"))


_compiled: dict[str, dict[str, tuple[ahocorasick.Automaton, list[str]]]] = {}


def compiled(phrases: dict[str, list[str]], key: str) -> dict[str, tuple[ahocorasick.Automaton, list[str]]]:
    """One automaton for each language; a worker keeps that of the shard that it scans."""
    if key not in _compiled:
        _compiled.clear()
        for lang, some in phrases.items():
            automaton = ahocorasick.Automaton()
            for i, phrase in enumerate(some):
                automaton.add_word(f" {phrase} ".encode("utf-8", "surrogatepass").decode("latin-1"), i)  # a character for each byte
            automaton.make_automaton()
            _compiled.setdefault(key, {})[lang] = automaton, some
    return _compiled[key]


def matches(texts: DataFrame, phrases: dict[str, list[str]]) -> DataFrame:
    """lang, phrase, f: occurrences of a shard's phrases, overlaps included, summed over the tasks."""
    shared = texts.sparkSession.sparkContext.broadcast(phrases)
    key = uuid.uuid4().hex

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, buffer in chunks(batch):
                if lang in shared.value:
                    automaton, _ = compiled(shared.value, key)[lang]
                    line = b" \n ".join(b" ".join(filter(None, x.split(b" "))) for x in buffer.split(b"\n"))
                    found.setdefault(lang, Counter()).update(map(itemgetter(1), automaton.iter(f" {line.decode('latin-1')} ")))
        pack = zstandard.ZstdCompressor(level=1)
        for lang, counts in found.items():
            cells = np.zeros(len(shared.value[lang]), np.int64)
            cells[list(counts.keys())] = list(counts.values())
            yield pd.DataFrame([(lang, i, pack.compress(cells[i : i + PHRASES].tobytes())) for i in range(0, len(cells), PHRASES)], columns=["lang", "first", "cells"])

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for lang, first, raw in zip(batch["lang"], batch["first"], batch["cells"], strict=True):
                some = np.frombuffer(unpack.decompress(raw), np.int64)
                sums[lang, first] = some + sums.get((lang, first), 0)
        for (lang, first), n in sums.items():
            yield pd.DataFrame({"lang": lang, "phrase": shared.value[lang][first : first + len(n)], "f": n})[n > 0]

    return texts.mapInPandas(scan, fields("lang string, first int, cells binary")).repartition("lang", "first").mapInPandas(total, fields("lang string, phrase string, f long"))


def counted_phrases(texts: DataFrame, found: DataFrame, mining: Mining) -> DataFrame:
    """The exact counts of all candidates, shard by shard; a shard's phrases are all that the driver ever holds."""
    n = found.count()
    shards = max(1, -(-n // mining.shard))
    out = []
    for i in range(shards):
        phrases: dict[str, list[str]] = {}
        for row in found.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)) == i).toLocalIterator():
            phrases.setdefault(row["lang"], []).append(row["phrase"])
        out.append(cut(matches(texts, phrases)))
    both = out[0]
    for more in out[1:]:
        both = both.unionByName(more)
    return both.where(F.col("f") >= mining.min_count)


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) of positive longs, exact: products have up to 38 digits."""
    wide = lambda c: c.cast("decimal(38,0)")
    over, under = (wide(a) * 1000).cast("decimal(38,0)") * wide(n), wide(left) * wide(right)
    return F.call_function("div", over.cast("decimal(38,0)"), under.cast("decimal(38,0)"))


def scored(words: DataFrame, phrases: DataFrame, totals: DataFrame, mining: Mining) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one takes the place of."""
    known = words.select("lang", F.col("word").alias("phrase"), "f").unionByName(phrases.select("lang", "phrase", "f"))
    size, part = F.size("w"), lambda a, b: F.array_join(F.slice("w", a, b), " ")
    held = phrases.withColumn("w", F.split("phrase", " ", -1))
    parts = held.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    sides = parts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # a phrase inside a longer one lies in one that has a single word more, whose count is between theirs
    inner = held.where(size > 2).select("lang", "f", F.explode(F.array(part(F.lit(1), size - 1), part(F.lit(2), size - 1))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    lowest = (
        sides.join(totals, "lang").withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*").drop("k")
    )
    return lowest.join(inner, ["lang", "phrase"], "left").where(F.col("above").isNull() | (100 * F.col("above") < mining.contained * F.col("a"))).drop("above")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", mining: Mining = Mining()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases."""
    texts = texts_of(docs, text, lang)
    every = stored(counted_words(texts), "words")
    totals = stored(every.where("word is null").select("lang", F.col("f").alias("n")), "totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = (min(max(total // mining.words_per_cell, mining.min_cells), mining.max_cells) - 1).bit_length()
    words = every.where(F.col("word").isNotNull() & (F.col("f") >= mining.min_count))
    frequent = word_filter(words, bits)
    found = stored(candidates(texts, frequent, sketch(texts, frequent, bits, mining), mining), "candidates")
    rows = scored(words, stored(counted_phrases(texts, found, mining), "phrases"), totals, mining)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for deal in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(32))], ["lang"]):  # the first of a part of a language's phrases, then of all
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*deal).orderBy(*order)).cast("long")).where(F.col("rank") <= mining.top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def sql(mining: Mining = Mining()) -> str:
    return f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER.decode()}', '{LOWER.decode()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(p, ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: w[i:i + k - 1])) AS p
        FROM pieces, (SELECT unnest(range(1, {mining.longest + 1})) AS k) WHERE len(w) >= k)
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
found AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= {mining.min_count}),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.f AS l, y.f AS r, t.n,
         CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM found) c
  JOIN totals t ON t.lang = c.lang
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM lowest s
  WHERE NOT EXISTS (SELECT 1 FROM found b WHERE b.lang = s.lang AND b.k > s.k AND 100 * b.a >= {mining.contained} * s.a
                    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {mining.top}"""


OP11_SQL = sql()
