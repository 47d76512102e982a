"""Collocations against a count of every phrase in plain Python, and the cases that the docstring defines."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import op11_collocations as op11

SMALL = op11.Mining(min_count=4, top=40, min_cells=1 << 17)


def mined(rows, mining):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, mining.longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= mining.min_count}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= mining.contained * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[: mining.top], 1)]
    return sorted(out)


def got(frame, mining=SMALL, **names):
    return sorted(tuple(r) for r in op11.collocations(frame, mining=mining, **names).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["a", "A", "aa", "b", "of", "The", "größe", "\xa0x", "é", "\x1c", "long" * 9, "'s", "\U0001f600"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n", "?", "\x0b"]) for _ in range(rng.randint(0, 60)))
    rows = [(text(), rng.choice(["en", "de", None, "und", ""])) for _ in range(60)]
    return [*rows, *rows[:3] * 2, (None, "en"), ("", None), (" .,\n", "fr"), ("a " * 4000, "en"), ("b b b b b b b", "xx")]


def test_against_counts(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, f int, `a.b` string").repartition(3)
    want = mined(rows, SMALL)
    assert got(frame) == want and len({r[0] for r in want}) >= 4
    half = op11.Mining(min_count=4, top=5, min_cells=1 << 17, contained=50, longest=3)
    assert got(frame, half) == mined(rows, half)


def test_sketch_size_and_shards_change_nothing(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    want = got(frame)
    # a sketch of a few cells proposes nearly everything, many automata scan, chunks hold single texts
    assert got(frame, op11.Mining(min_count=4, top=40, min_cells=64, max_cells=64, shard=25)) == want
    monkeypatch.setattr(op11, "CHUNK", 1)
    assert got(frame) == want


def test_names_and_no_rows(spark, rows):
    frame = spark.createDataFrame(rows, "`t.x` string, `phrase` string")
    assert got(frame, text="t.x", lang="phrase") == mined(rows, SMALL)
    assert got(frame.limit(0), text="t.x", lang="phrase") == []
    assert op11.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 987_654_321_987, 912_345_678_912_345, 987_654_321_988, 1_000_000_007
    frame = spark.createDataFrame([(a, n, left, right), (100, 10**15, 100, 101), (10**12, 10**15, 10**12, 10**12)], "a long, n long, l long, r long")
    rows = frame.select("*", op11.score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in rows] == [1000 * r.a * r.n // (r.l * r.r) for r in rows]


def test_bounds_are_never_below_counts(spark):
    texts = op11.texts_of(spark.createDataFrame([("x y z. " * 9, "en"), ("x y q", "en")], "text string, lang string"), "text", "lang")
    mining = op11.Mining(min_count=9)
    words = op11.word_filter(op11.counted_words(texts).where("word is not null and f >= 9"), 17)
    found = {r.phrase for r in op11.candidates(texts, words, op11.sketch(texts, words, 17, mining), mining).collect()}
    assert found == {"x y", "y z", "x y z"}
