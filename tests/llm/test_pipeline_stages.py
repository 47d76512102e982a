"""The pipeline's stages on a small table against plain versions of each, and on rows and columns that are unlike documents."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import op10_line_frequency
from tests.llm.test_corpus_operators import lcs

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, score double, kept int, line string"


def good(text):
    """The rules of the current policy, written apart from the ledger."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = {i + j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return not (
        n < 10 or 100 * len(twice) > 20 * n or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
        or 2 * (len(lines) - len(set(lines))) > len(lines) or sum(map(len, words)) > 20 * n
    )


def without_lines(docs):
    """Lines of over 2 % (and at least five) of a source's different texts are gone."""
    limits, pages, total = op10_line_frequency.Boilerplate(), Counter(), Counter()
    for source, text in {(d[3], d[1]) for d in docs}:
        total[source] += 1
        for line in {x.strip(" \t\r\x0b\x0c") for x in (text or "").split("\n")} - {""}:
            pages[source, line] += 1
    gone = {k for k, n in pages.items() if n >= limits.min_pages and n > limits.ratio * total[k[0]]}
    out = []
    for d in docs:
        text = None if d[1] is None else "\n".join(x for x in d[1].split("\n") if (d[3], x.strip(" \t\r\x0b\x0c")) not in gone)
        out.append((d[0], text, *d[2:4], None if text is None else len(text), *d[5:]))
    return out


def one_of_each(docs):
    """The first document of each class of texts whose words are to 0.8 or more alike."""
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    words = [(d[1] or "").split() for d in docs]
    bags = [Counter(w) for w in words]
    for i in range(len(docs)):
        for j in range(i):
            size = len(words[i]) + len(words[j])
            if words[i] == words[j] or (size and 2 * sum((bags[i] & bags[j]).values()) >= 0.8 * size and 2 * lcs(words[i], words[j]) >= 0.8 * size):
                group[max(root(i), root(j))] = min(root(i), root(j))
    kinds = {}
    for i, d in enumerate(docs):
        kinds.setdefault(root(i), []).append(d[0])
    return sorted(min(ids) for ids in kinds.values())


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(21)
    words = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "ra", "se", "ti") for b in ("den", "lor", "mar", "nis", "pal", "tur", "vex")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [f"{prose(14)}\n{prose(9)}\nread our menu and terms here\n{prose(rng.randint(20, 60))}" for _ in range(70)]
    for i in range(12):  # near copies: a word in fifteen is another
        texts.append(" ".join(rng.choice(words) if rng.random() < 0.06 else w for w in texts[i % 4].split(" ")))
    texts += [texts[5]] * 3 + [f"You are a worthless snorkwit and {prose(25)}" for _ in range(60)] + [f"{prose(30)} ### $$$ %%% &&& ***"] + ["few words only", prose(3) + " " + " ".join([prose(5)] * 9), "", None, "x" * 400]
    texts += ["\n".join([prose(12)] + ["again and again"] * 9)]
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), "x", 1.0, 0, "l") for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("snorkwit" in (t or ""))) for i, t in enumerate(texts) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, str(folder)


def test_every_stage_does_what_it_says(spark, made):
    rows, folder = made
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    state = lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
    docs = corpus_pipeline.stored(STAGES["quality_rules"](spark, docs, folder), "t")
    want = [r for r in rows if good(r[1])]
    assert state(docs) == sorted(want, key=repr) and 0 < len(rows) - len(want) < 12
    docs = corpus_pipeline.stored(STAGES["toxicity"](spark, docs, folder), "t")
    want = [r for r in want if "snorkwit" not in r[1]]
    assert state(docs) == sorted(want, key=repr)
    docs = corpus_pipeline.stored(STAGES["line_dedup"](spark, docs, folder), "t")
    before, want = want, without_lines(want)
    assert state(docs) == sorted(want, key=repr) and sum(a != b for a, b in zip(before, want, strict=True)) >= 70
    docs = corpus_pipeline.stored(STAGES["near_dedup"](spark, docs, folder), "t")
    assert sorted(r.doc_id for r in docs.collect()) == one_of_each(want) and len(one_of_each(want)) < len(want)
    packed_exactly({r.doc_id: r.text for r in docs.collect()}, STAGES["packing"](spark, docs, folder).collect())


def packed_exactly(texts, pieces):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    by, sequences = {i: [] for i in ids}, {}
    for p in pieces:
        assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        by[p.doc_id].append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, some in by.items():
        at = 0
        for start, length in sorted(some):
            assert start == at
            at += length
        assert at == len(ids[i])
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0


def test_whole_run_is_its_stages(spark, made):
    _, folder = made
    pieces = corpus_pipeline.run(spark, folder).collect()
    rows = {r[0]: r for r in made[0]}
    kept = {p.doc_id for p in pieces}
    assert kept and all(good(rows[i][1]) and "snorkwit" not in rows[i][1] for i in kept)


def test_rows_and_columns_unlike_documents(spark, made, tmp_path):
    rows, folder = made
    odd = [(None, None, None, None, None, None, None, None, None), (7, rows[0][1], None, None, 3, "y", None, 2, "l"), (7, rows[0][1], None, None, 3, "y", None, 2, "l"), (8, "word " * 30_000, "en", "s", 1, "x", 1.0, 0, "l")]
    for some in (odd, []):
        docs = spark.createDataFrame(some, SCHEMA)
        for name, stage in list(STAGES.items())[:-1]:
            after = stage(spark, docs, folder)
            assert after.columns == docs.columns and after.count() <= len(some), name
        assert STAGES["packing"](spark, docs, folder).agg(F.sum("length")).first()[0] == (None if not some else sum(r.length for r in STAGES["packing"](spark, docs, folder).collect()))
    once = STAGES["near_dedup"](spark, spark.createDataFrame(odd, SCHEMA), folder)
    assert sorted(r.doc_id for r in once.where("doc_id is not null").collect()) == [7, 8]
    empty = str(tmp_path / "none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
