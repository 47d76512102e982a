"""Operators that work on one row at a time: brute force, exact round trips, and the cases that each docstring defines."""

import base64
import hashlib
import os
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import op3_toxicity, op4_ogg, op6_rule_ledger, op8_bpe, op9_mincut

ODD = ["", "  \n\n  x", "日本語テキスト🎉🎉", "a" * 5000, "don't  we'll 123456 $$$###", "é́ �", "<|endoftext|>", " " * 500 + "z", "x " * 3000, "\r\n\t\x0b\x0c"]


def frame(spark, texts, extra=""):
    return spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)], "doc_id long, text string, media string, score int")


# --- 8


@pytest.fixture(scope="module")
def coder():
    return op8_bpe.Coder(op8_bpe.rank_file(public_tokenizers.path(op8_bpe.VOCABULARY)), public_tokenizers.PATTERN)


def test_bpe_gives_the_library_s_ids(coder):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéñ \n.,'0123456789日🎉"
    for text in ODD + ["".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(300)]:
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_the_hash_is_minimal_and_perfect(coder):
    places = {coder.hash.find(k) for k in coder.ranks}
    assert places == set(range(len(coder.ranks)))
    assert coder.hash.find(b"certainly no token of it") == -1
    assert op8_bpe.MinimalPerfectHash([]).find(b"a") == -1


def test_bpe_memory_is_bounded(coder, monkeypatch):
    monkeypatch.setattr(op8_bpe, "REMEMBERED", 20)
    for i in range(200):
        coder.encode(f"word{i} other{i}")
    assert len(coder.met) + len(coder.older) <= 21


def test_bpe_columns(spark):
    tokenizer = op8_bpe.Tokenizer(spark, op8_bpe.rank_file(public_tokenizers.path(op8_bpe.VOCABULARY)))
    rows = frame(spark, [None, "", "hello world", "hello world"])
    got = rows.select("doc_id", tokenizer.both("text").alias("b")).orderBy("doc_id").collect()
    assert [bytes(r.b.decoded) for r in got] == [b"", b"", b"hello world", b"hello world"] and bytes(got[2].b.ids) == bytes(got[3].b.ids)
    ids = rows.select("doc_id", tokenizer.encode("text").alias("ids"))
    assert [bytes(r.d).decode() for r in ids.select("doc_id", tokenizer.decode("ids").alias("d")).orderBy("doc_id").collect()] == ["", "", "hello world", "hello world"]
    assert rows.limit(0).select(tokenizer.both("text")).count() == 0


# --- 4


def crc(data):
    value = 0
    for byte in data:
        value ^= byte << 24
        for _ in range(8):
            value = (value << 1 ^ 0x04C11DB7 if value & 0x80000000 else value << 1) & 0xFFFFFFFF
    return value


def test_ogg_checksum():
    for data in (b"", b"OggS", bytes(range(256)) * 3):
        assert op4_ogg.checksum(data) == crc(data)


@pytest.mark.parametrize("text", [*ODD, "long " * 100_000])
def test_ogg_round_trip(text):
    payload, n = op4_ogg.padded(text)
    assert len(payload) % 576 == 0 and len(payload) >= 576 and payload[n:] == b"\xff" * (len(payload) - n)
    back, times, notes = op4_ogg.samples(op4_ogg.read(op4_ogg.write(payload, {"n_bytes": n})))
    assert back == payload and back[: notes["n_bytes"]].decode() == text
    assert times == [pytest.approx((i + 1) * 576 / op4_ogg.RATE) for i in range(len(payload) // 576)]


def test_ogg_packets_over_page_bounds_and_streams_apart():
    big, other = bytes(range(256)) * 300, b"other"
    lacing = op4_ogg.laced(len(big))
    cut = 255 * 255
    pages = [op4_ogg.page(7, 0, -1, op4_ogg.FIRST, lacing[:255], big[:cut]), op4_ogg.page(9, 0, 5, op4_ogg.FIRST | op4_ogg.LAST, op4_ogg.laced(5), other), op4_ogg.page(7, 1, len(big), op4_ogg.CONTINUED | op4_ogg.LAST, lacing[255:], big[cut:])]
    streams = op4_ogg.read(b"".join(pages))
    assert streams[7].packets == [big] and streams[7].granules == [len(big)] and streams[9].packets == [other]


def test_ogg_damage_is_found():
    media = op4_ogg.write(*(lambda p: (p[0], {"n_bytes": p[1]}))(op4_ogg.padded("some text " * 200)))
    for at in (0, 30, len(media) // 2, len(media) - 1):
        with pytest.raises(ValueError):
            op4_ogg.read(media[:at] + bytes([media[at] ^ 1]) + media[at + 1 :])
    with pytest.raises(ValueError):
        op4_ogg.read(media[:-600])


def test_ogg_query(spark, tmp_path):
    texts = [None, "", "a", "a", "x" * 3000]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op4_ogg.op4_ogg_samples(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        payload, n = op4_ogg.padded(text or "")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    apart = spark.read.parquet(str(tmp_path / "documents.parquet")).select("doc_id", op4_ogg.stored_media(F.coalesce("text", F.lit(""))).alias("media"))
    again = apart.select("doc_id", F.sha2("media", 256).alias("m"), op4_ogg.read_media("media").alias("r")).collect()
    assert all(r.m == got[r.doc_id].media_sha256 and r.r.feature == got[r.doc_id].feature for r in again)
    assert got[2].media_sha256 == got[3].media_sha256 and got[0].media_sha256 == got[1].media_sha256 != got[2].media_sha256


# --- 6


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    places = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(places)


def test_measurements_by_brute_force():
    rng = random.Random(2)
    for text in [None, *ODD[:4], *ODD[5:8], *(" ".join(rng.choices(["a", "b", "c\n", "d#", "ee"], k=rng.randint(0, 60))) for _ in range(200))]:
        assert op6_rule_ledger.measure(text) == brute(text)


def test_ledger_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = spark.createDataFrame([(1, good, 5), (2, "too short", 5), (3, good + " # * | $ % & < > # # #", 5), (4, None, 5), (5, "a b c d e " * 6, 5)], "doc_id long, text string, failed int")
    found = op6_rule_ledger.ledger(rows, prefix="ledger_").orderBy("doc_id").collect()
    assert [r.ledger_failed for r in found] == [0, 1, 4, 1, 2] and found[0].failed == 5
    table = {r.rule: r for r in op6_rule_ledger.ablations(op6_rule_ledger.ledger(rows.drop("failed"))).collect()}
    assert table["few_words"].n_only == 2 and table["symbols"].kept_without == 2 and table["symbols"].n_docs == 5
    kept = op6_rule_ledger.stage(spark, rows, "")
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == rows.columns
    assert op6_rule_ledger.ledger(rows.limit(0), prefix="l_").count() == 0


# --- 9

PAGE = """<html><head><title>x</title><script>var a = "<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Alpha</a></li></ul></nav>
<div id="cookie-notice">We use cookies, and say so at such length that it looks like content to a classifier that only counts characters.</div>
<main><article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>&nbsp;three<p>Four<br>five &#233; <a href=x>link</a>.</p><ul><li>Item one</li><li>Item two</ul><div class="comments"><p>Nice article, says a reader, at some length.</p></div></article></main>
<aside>Side</aside><form><p>Your mail</p></form><footer>foot</footer></body></html>"""


def text_of(page):
    return op9_mincut.extract(page)[0]


def test_main_text():
    assert text_of(PAGE) == "Title & more\n\nOne two three\n\nFour five é link.\n\nItem one\n\nItem two"
    for broken in ("", "<", "<<>>", "<div", "<script>never closed <p>text", "<!-- open", "<a " * 50_000, "<div>" * 5000 + "x", "<p class='unclosed" + "x" * 10_000):
        text_of(broken)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<body class="single post has-sidebar"><article><p>Kept.</p></article><div class="sidebar-left"><p>Gone, however long it is, and it is as long as a text can be.</p></div>', "Kept."),
        ('<body class="post share-enabled"><article><header class="article-header"><h1 class="article-header">Head</h1></header><p>Kept.', "Head\n\nKept."),
        ("<article><p>A <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b <svg><text>c</text></svg><noscript>d</noscript></article>", "A x=1 b c\n\nd"),
        ('<main><p>Kept.<div class="ad-container"><p>An advert that reads like a text, and is as long as one, with a full stop.</p></div><p>Also.</main>', "Kept.\n\nAlso."),
        ('<article><p>Kept.</p><section class="comments"><article><p>A reader says so, at length, in whole sentences, as readers do.</p></article></section></article>', "Kept."),
        ("<form><article><p>Kept.</p></article><p>Your name, please, in the field below, which we will not give away.</p></form>", "Kept."),
        ('<article><ul><li><a href="/x">Only a link</a></li><li><a href="/y">Another</a></li></ul><p>Les.</p></article>', "Only a link\n\nAnother\n\nLes."),
        ('<div><div><a href="/">Home</a></div></div><div><h2>Head</h2><p>%s</p><p>%s</p></div>' % ("A whole sentence of the text. " * 9, "Another one. " * 15), "Head\n\n" + ("A whole sentence of the text. " * 9).strip() + "\n\n" + ("Another one. " * 15).strip()),
    ],
)
def test_main_text_cases(page, want):
    assert text_of(page) == want


def page_of(rng):
    tags = ["<div>", "<div class='ad'>", "<div class='content'>", "<article>", "<nav>", "<p>", "<p>", "<h2>", "<li><a href=x>", "</div>", "</article>", "</nav>", "<section class='sidebar-content'>", "</section>"]
    return "".join(rng.choice(tags) + " ".join(["word"] * rng.choice([0, 1, 4, 30])) + rng.choice(["", "."]) for _ in range(12))


def test_cut_is_minimal():
    rng, costs = random.Random(4), op9_mincut.Costs()
    for _ in range(150):
        found, holders = op9_mincut.blocks(page_of(rng))
        n, edges = op9_mincut.graph(found, holders, costs)
        if n > 14:
            continue
        price = lambda side: sum((there if side[a] and not side[b] else back if side[b] and not side[a] else 0) for a, b, there, back in edges)  # noqa: E731, B023
        least = min(price([True, False, *(bool(m >> i & 1) for i in range(n - 2))]) for m in range(1 << n - 2))
        assert price(op9_mincut.max_flow(n, edges)) == pytest.approx(least)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_edges_change_labels_of_real_pages():
    import pyarrow.parquet as pq

    alone = op9_mincut.Costs(tied=0.0, loose=0.0, neighbour=0.0)
    changed = flipped = total = 0
    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist():
        found, holders = op9_mincut.blocks(page or "")
        with_edges, without = op9_mincut.content(found, holders), op9_mincut.content(found, holders, alone)
        changed += sum(a != b for a, b in zip(with_edges, without, strict=True))
        flipped += op9_mincut.extract(page or "")[1]
        total += len(found)
    assert changed == flipped > 0.02 * total


@pytest.mark.parametrize("page", ["<b>" * 300_000 + "<p>x" * 300_000, "<div>" * 400_000 + "</section>" * 400_000, "<div>x" * 300_000, "<div class=ad>x" * 150_000, "<p>A text that goes on.</p>" * 100_000 + "<ul>" + "<li><a>z</a>" * 50_000])
def test_long_pages_take_time_in_proportion(page):
    took = []
    for part in (page[: len(page) // 4], page):
        began = time.perf_counter()
        text_of(part)
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 2 and took[1] < 60


def test_fit_keeps_what_no_page_contradicts(spark):
    empty = spark.createDataFrame([], "html string")
    assert op9_mincut.fitted(empty) == op9_mincut.Costs()
    pages = spark.createDataFrame([(PAGE,), (None,)] * 20, "html string")
    weights = dict(zip(op9_mincut.FEATURES, op9_mincut.fitted(pages).text, strict=True))
    assert weights["links"] < 0 < weights["paragraph"]


def test_extraction_query(spark, tmp_path):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (2, "u", "", "x"), (3, None, PAGE, "x"), (3, None, PAGE, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    got = op9_mincut.op9_mincut_extraction(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, n := len(text_of(PAGE))), (2, 0), (2, 0), (3, n), (3, n)] and all(len(r.text) == r.n_chars for r in got)
    frame.limit(0).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op9_mincut.op9_mincut_extraction(spark, str(tmp_path / "none")).count() == 0


# --- 3


def test_grammar_composition():
    g = op3_toxicity.Grammar({"idiot": 1.0, "scu*": 1.0, "moron": 0.5})
    kinds = lambda t: {k: v for k, v in zip(op3_toxicity.EMISSIONS, g.emissions(t), strict=True) if v}
    assert kinds("What an idiot.") == {"plain": 1.0}
    assert kinds("You are an idiot.") == {"aimed": 1.0} and kinds("Idiot, you!") == {"aimed": 1.0}
    assert kinds("That is not an idiot.") == {"negated": 1.0}
    assert kinds('He said "idiot" twice') == {"reported": 1.0}
    assert kinds("not here. idiot there") == {"plain": 1.0}  # negation ends with its clause
    assert kinds("I will kill you") == {"threat": 1.0} and kinds("they kill time") == {"threat": 1.0} and kinds("to kill time") == {"loose_threat": 1.0}
    assert kinds("scumble") == {"plain": 1.0} and kinds("idiots") == {} and kinds("") == {}
    score = lambda t: g.score(g.features(t))
    assert score("you idiot") > score("an idiot") > score("not an idiot") > score("")
    filler = "A sentence of a text of some length. " * 10
    assert score(f"{filler} An idiot there. {filler}") < 0.5 < score(f"{filler} An idiot there. {filler} A moron, an idiot. {filler}") < score(f"{filler} You idiot. {filler} You moron.")


def test_best_path_is_that_of_all_paths():
    machine, rng = op3_toxicity.clause_machine(3, 4), random.Random(9)
    for _ in range(400):
        symbols = rng.choices(op3_toxicity.SYMBOLS, weights=(4, 2, 2, 1, 1, 6), k=rng.randint(0, 11))
        every = sorted(machine.paths(symbols), key=lambda x: -x[0])
        assert every and len(machine.best(symbols)) == len(symbols)
        assert machine.best(symbols) in [out for weight, out in every if weight == every[0][0]]


def test_composition_is_one_machine_after_the_other():
    rng = random.Random(3)
    one, two, three = op3_toxicity.negation_machine(2), op3_toxicity.report_machine(), op3_toxicity.target_machine(2)
    whole = op3_toxicity.composed(op3_toxicity.composed(one, two), three)
    for _ in range(200):
        symbols = rng.choices(op3_toxicity.SYMBOLS, k=rng.randint(0, 7))
        apart = [(w1 + w2 + w3, c) for w1, a in one.paths(symbols) for w2, b in two.paths(a) for w3, c in three.paths(b)]
        assert sorted(whole.paths(symbols)) == sorted(apart)


def test_toxicity_of_no_rows_and_of_clashing_names(spark):
    frame = spark.createDataFrame([(1, "I will kill you", 7, "x")], "doc_id long, text string, score int, emitted string")
    grammar = op3_toxicity.Grammar()
    got = op3_toxicity.scored(frame, grammar, emitted="emitted")
    assert got.columns == [*frame.columns, "score_", "emitted_"] and got.first().score == 7 and got.first().score_ > 0.5
    assert op3_toxicity.scored(frame.limit(0), grammar).count() == 0


def test_toxicity_is_learned_and_held_out(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        text = " ".join(rng.choices(words, k=25) + ["zzgrob" + rng.choice("xyz")] * 2 * toxic)
        docs.append((i, text, "extra"))
        labels += [(i, 1, int(toxic))] * rng.choice([1, 1, 2])
    docs += [(5000, None, "e"), (5001, "", "e"), (None, docs[0][1], "e"), (5002, "x" * 200_000, "e")]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    grammar = op3_toxicity.learn(d.select("doc_id", "text"), lab)
    assert any(k.startswith("zzg") for k in grammar.insults)
    got = op3_toxicity.scored(d, grammar, score="s").collect()
    assert all((r.s >= 0.5) == (r.doc_id % 5 == 0) for r in got if r.doc_id is not None and r.doc_id < 1500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert len(got) == len(docs) and len({r.s for r in got if r.doc_id in (5000, 5001)}) == 1 and all(0 <= r.s <= 1 for r in got)
    held = {r.doc_id: r.h for r in d.select("doc_id", op3_toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items() if i is not None) and held[None] is False


def test_toxicity_without_labels(spark):
    d = spark.createDataFrame([(1, "I will kill you"), (2, "good day")], "doc_id long, text string")
    grammar = op3_toxicity.learn(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert op3_toxicity.learn(d.limit(0), spark.createDataFrame([], "doc_id long, toxic int")) == grammar
    assert [r.score >= 0.5 for r in op3_toxicity.scored(d, grammar).orderBy("doc_id").collect()] == [True, False]


def test_ranks_are_those_of_the_file(coder):
    first = next(iter(op8_bpe.rank_file(public_tokenizers.path(op8_bpe.VOCABULARY)).splitlines())).split()
    assert coder.ranks[base64.b64decode(first[0])] == int(first[1])


SAID = "This is a long sentence of prose that says something about the matter at hand, and it goes on for a while longer."


@pytest.mark.parametrize(
    "page",
    [
        '<main><p id="form-of-government">A</p></main>',
        '<main><div class="search-results-study"><p>A</p></div></main>',
        '<article><p>A</p><p class="legal">A</p><p class="share-price">A</p></article>',
        '<article><p>A</p><section class="discussion"><p>A</p><p>A</p></section><div class="related-work"><p>A</p></div><p class="legal">A</p></article>',
        '<main><section><div><p class="notice">A</p><div><p>A</p></div></div></section></main>',
    ],
)
def test_a_word_of_a_name_never_empties_an_article(page):
    n = page.count(">A<")
    assert text_of(page.replace(">A<", f">{SAID}<")) == "\n\n".join([SAID] * n)


def test_adverts_and_shares_inside_an_article_go():
    page = f'<article><p>{SAID}</p><div class="advert"><p>{SAID}</p></div><div class="ad-slot"><p>Buy now.</p></div><div class="share"><a href=x>Tweet</a> <a href=y>Mail</a></div><p>{SAID}</p></article><noscript>Turn it on.</noscript>'
    assert text_of(page) == f"{SAID}\n\n{SAID}"


@pytest.mark.parametrize("depth", [3, 10, 71, 200, 3000])
@pytest.mark.parametrize("menu", ["nav", 'div class="menu"'])
def test_depth_changes_nothing(depth, menu):
    inside = f"<{menu}><ul><li><a href=x>Home</a></li><li>About us</li></ul></{menu.split()[0]}><p>{SAID}</p>"
    assert text_of("<div>" * depth + inside + "</div>" * depth) == SAID
