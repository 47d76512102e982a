"""Operators that compare rows: against brute force, and the cases that each docstring defines."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import op1_chat, op2_order_minhash, op5_url_rules, op7_retrieval_packing, op10_line_frequency

# --- 1


def rotated(rows):
    out = defaultdict(list)
    for who in {(r[0], r[2] or "unknown") for r in rows if r[2] != "system"}:
        mine = sorted((r for r in rows if r[0] == who[0]), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "unknown", r[3] or ""))
        for _, turn, speaker, said in mine:
            speaker = speaker or "unknown"
            kind = "system" if speaker == "system" else "assistant" if speaker == who[1] else f"user name={speaker}"
            out[who].append((turn, f"<|{kind}|>\n{said or ''}<|end|>\n"))
    return out


def test_rotation(spark, monkeypatch):
    monkeypatch.setattr(op1_chat, "BLOCK", 3)
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["ann", "bob", "cy"]), f"t{t} " * rng.randint(0, 5)) for c in (1, 2, None) for t in range(12)]
    rows += [(1, None, "ann", "before all"), (1, 4, None, None), (1, 4, "ann", "tie"), (1, 4, "ann", "tie"), (2, 0, "system", "be good"), (3, 0, "system", "alone"), (1, -5, "bob", "early")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, kind string, start int")
    got = defaultdict(list)
    for r in op1_chat.rotate(frame).collect():
        got[r.conv_id, r.perspective].append(r)
    want = rotated(rows)
    assert set(got) == set(want)
    for who, said in want.items():
        mine = sorted(got[who], key=lambda r: (r.start, r.n_chars))
        whole = "".join(x for _, x in said)
        assert "".join(r.content for r in mine) == whole
        for r in mine:
            assert whole[r.start : r.start + r.n_chars] == r.content and r.mask == (r.speaker == who[1])
            assert whole[r.mask_start : r.mask_end] == (r.content.split("\n", 1)[1] if r.mask else "")
    assert op1_chat.rotate(frame.limit(0)).count() == 0


# --- 2


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_banded_alignment_is_exact():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.randint(0, rng.choice([2, 8, 50])) for _ in range(rng.randint(0, 60))]
        b = [x for x in a if rng.random() < 0.9] + [rng.randint(0, 8) for _ in range(rng.randint(0, 5))]
        assert op2_order_minhash.common(a, b, len(a) + len(b)) == lcs(a, b)
        for s in (0.5, 0.8, 1.0):
            want = not (a or b) or 2 * lcs(a, b) / (len(a) + len(b)) >= s - 1e-12
            assert op2_order_minhash.alignment(np.array(a, np.uint64), np.array(b, np.uint64), s) == want


def test_sketch_keeps_the_order():
    near = op2_order_minhash.Near(picks=2, rows=1, bands=200)
    words = op2_order_minhash.word_hashes(" ".join(f"w{i}" for i in range(400)))
    moved = np.concatenate([words[200:], words[:200]])
    sketch = lambda w: op2_order_minhash.sketches(op2_order_minhash.labelled(op2_order_minhash.kmers(w, 5)), near)
    same, other = sketch(words), sketch(moved)
    assert (same == sketch(words)).all() and 0.2 < (same == other).mean() < 0.8  # nearly all k-mers agree, half of the orders do not
    labels = op2_order_minhash.labelled(np.array([5, 5, 7, 5], np.uint64))
    assert len(set(labels.tolist())) == 4


def corpus(seed=6):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 7))) for _ in range(4000)]
    make = lambda n: rng.choices(vocabulary, k=n)
    docs = [make(rng.randint(1, 300)) for _ in range(150)]
    base = make(200)
    for _ in range(60):  # a large group of near copies
        copy = list(base)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        docs.append(copy)
    docs += [base] * 40  # and of exact ones
    for d in docs[:30]:
        docs.append([w for w in d if rng.random() > 0.02])
    passage = make(60)
    docs += [make(60) + passage + make(60) for _ in range(40)]  # a shared passage makes no copy
    return [" ".join(d) for d in docs]


def test_classes_by_brute_force(spark):
    texts = corpus()
    rows = [(i * 3 + 1, t, i) for i, t in enumerate(texts)] + [(9001, None, 0), (9002, "", 0), (9003, "...", 0), (None, "only one", 0), (9005, texts[0].upper() + "!", 0), (9006, texts[3], 0), (9006, texts[3], 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, t int")
    hashes = [op2_order_minhash.word_hashes(r[1] or "") for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if op2_order_minhash.alignment(hashes[a], hashes[b], 0.8):
            parent[root(a)] = root(b)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r[0])
    want = Counter((min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for _ in g)
    for small in (24, 3):  # both ways of making pairs
        got = op2_order_minhash.classes(frame, near=op2_order_minhash.Near(small=small)).collect()
        assert Counter((r.class_id, r.class_size) for r in got) == want
    kept = op2_order_minhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and kept.count() == len(groups)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(min((x for x in g if x is not None), default=None) for g in groups.values())
    assert op2_order_minhash.classes(frame.limit(0)).count() == 0 and op2_order_minhash.drop_near_duplicates(frame.limit(0)).count() == 0


# --- 5


def fixed(url):
    """The given rules by plain string work."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(h + p, v) for v, h, p in op5_url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit, key=lambda x: len(x[0]), default=(None, None))


URLS = [None, "", "no url", "http://", "http://a.net", "http://a.net/", "https://WWW.Example.NET/en/x?y=1#z", "http://example.net/de/", "http://badexample.com/de/1", "http://m.example.com/de/1", "x://org/fr/a", "http://a.org/fr/1?u=http://b.net/", "a://b#c://d.net/", "http://ünï.net/en/\nx", "http://net/"]


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string")
    got = {}
    for r in op5_url_rules.judge(pages, spark.createDataFrame([], "url string, bad boolean")).collect():
        got.setdefault(r.page_id, r)
    assert len(got) == len(URLS) + 3
    for i, url in enumerate(URLS):
        host, path, rule = fixed(url)
        assert (got[i].host_, got[i].path, got[i].rule) == (host, path, rule[0] if rule else None), url
        assert got[i].verdict == (rule[1] if rule and rule[0] else "allow") and got[i].host == "h"


def loose(**settings):
    """Support and confidence alone."""
    return op5_url_rules.Mining(**{"min_count": 1, "min_lift": 0.0, "margin": None, "held_out": 0} | settings)


def test_labels_that_say_nothing_about_urls_give_no_rule(spark):
    rng = random.Random(2)
    urls = [f"http://{rng.choice('abc')}.{rng.choice(['ads-track', 'news', 'casino-win'])}.org/{rng.choice('xyz')}/{i}?q={i}&{rng.choice('uvw')}=1" for i in range(1500)]
    noise = spark.createDataFrame([(u, rng.random() < 0.25) for u in urls], "url string, bad boolean")
    assert op5_url_rules.mined_rules(noise).count() == 0
    told = spark.createDataFrame([(u, rng.random() < (0.8 if "casino" in u else 0.1)) for u in urls], "url string, bad boolean")
    rules = op5_url_rules.mined_rules(told).collect()
    assert {"bit=casino"} in [set(r["items"]) for r in rules] and all(r.confidence > 0.6 and r.n >= 10 for r in rules)
    assert op5_url_rules.useful(told)


def test_urls_of_no_pages_long_ones_and_clashing_names(spark):
    told = spark.createDataFrame([(f"http://{'bad' if i % 2 else 'good'}.org/{i}", i % 2 == 1) for i in range(200)], "url string, bad boolean")
    long = "http://bad.org/" + "/".join(f"part{i}x" for i in range(20_000)) + "?" + "&".join(f"k{i}=v" for i in range(20_000))
    pages = spark.createDataFrame([(1, long, "h", "g"), (2, "http://good.org/1", "h", "g"), (2, "http://good.org/1", "h", "g")], "page_id long, url string, host string, host_ string")
    got = op5_url_rules.judge(pages, told)
    assert got.columns[:4] == pages.columns and "host__" in got.columns and len(set(got.columns)) == len(got.columns)
    assert sorted((r.page_id, r.verdict, r.host__) for r in got.collect()) == [(1, "block", "bad.org"), (2, "allow", "good.org"), (2, "allow", "good.org")]
    assert op5_url_rules.judge(pages.limit(0), told).count() == 0


def test_mined_rules(spark):
    rng = random.Random(9)
    urls = [f"http://{rng.choice(['a', 'b', 'c'])}.example{rng.randint(0, 3)}.biz/{rng.choice(['ads', 'news'])}/{i}.{rng.choice(['html', 'php'])}" for i in range(600)]
    bad = lambda u: "/ads/" in u and u.endswith("php")
    labelled = spark.createDataFrame([(u, bad(u)) for u in urls[:400]] + [(None, True), (urls[0], None)], "url string, bad boolean")
    rules = op5_url_rules.mine(labelled, loose(min_support=0.1, min_confidence=0.9)).collect()
    # an extension and a last part with that extension go together here; every rule is as general as can be
    assert {"extension=php first_part=ads", "first_part=ads last_part=0.php"} <= {" ".join(sorted(r["items"])) for r in rules}
    assert all(r.confidence >= 0.9 and not any(set(o["items"]) < set(r["items"]) and o.confidence >= r.confidence for o in rules) for r in rules), rules
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = op5_url_rules.judge(pages, labelled, mining=loose(min_support=0.1, min_confidence=0.9)).collect()
    assert all((r.verdict == "block") == bad(r.url) for r in got) and len(got) == 600
    wide = op5_url_rules.judge(pages, labelled, mining=loose(min_support=0.1, min_confidence=0.9, broadcast_rules=0)).collect()
    assert sorted((r.page_id, r.verdict) for r in wide) == sorted((r.page_id, r.verdict) for r in got)


@pytest.mark.parametrize("where", ["http://www.{}.example.org/x/{n}.html", "http://h.example.org/en/{}/deep/{n}.html", "http://h.example.org/en/{n}.html?a{m}=1&{}=2", "http://h.example.org/en/{n}.html?q={}&a{m}=1"])
def test_every_token_of_a_url_can_be_a_rule(spark, where):
    urls = [(where.format("ads-track" if i % 4 == 0 else f"calm{'abcdefg'[i % 7]}", n=i, m="abcdefghijk"[i % 11]), i) for i in range(240)]
    labelled = spark.createDataFrame([(u, i % 4 == 0) for u, i in urls[:160]], "url string, bad boolean")
    pages = spark.createDataFrame([(i, u) for u, i in urls], "page_id long, url string")
    mining = loose(min_support=0.05, min_confidence=0.9)
    got = op5_url_rules.judge(pages, labelled, rules=(), mining=mining).collect()
    assert all((r.verdict == "block") == (r.page_id % 4 == 0) and (r.mined is None or "ads-track" in r.mined) for r in got) and len(got) == 240
    wide = op5_url_rules.judge(pages, labelled, rules=(), mining=loose(min_support=0.05, min_confidence=0.9, broadcast_rules=0)).collect()
    assert sorted((r.page_id, r.verdict) for r in wide) == sorted((r.page_id, r.verdict) for r in got)


def test_rules_of_long_urls_by_brute_force(spark):
    rng = random.Random(4)
    tail = "/".join(f"long{c}" for c in "abcdefghijklmnopqrst")  # twenty parts that always go together: one class, not 2 ** 20 item sets
    urls = [f"http://{rng.choice('ab')}.site.org/" + (f"{tail}/{i}" if i % 3 else f"{rng.choice('xy')}/{i}") for i in range(90)]
    labels = [(u, "long" in u and u.startswith("http://a")) for u in urls]
    got = {frozenset(r["items"]): (r.n, r.confidence) for r in op5_url_rules.mine(spark.createDataFrame(labels, "url string, bad boolean"), loose(min_support=0.1, min_confidence=0.6)).collect()}
    assert {frozenset({"first_label=a", f"part=long{c}"}) for c in "abcdefghijklmnopqrst"} <= set(got)
    baskets = [(set(r.items_), r.bad) for r in spark.createDataFrame(labels, "url string, bad boolean").select(op5_url_rules.items_of(F.col("url")).alias("items_"), "bad").collect()]
    counted = lambda s: [sum(s <= b and y for b, y in baskets), sum(s <= b for b, _ in baskets)]
    items = set().union(*[b for b, _ in baskets])
    want = {}
    for size in (1, 2):
        for s in map(frozenset, itertools.combinations(sorted(items), size)):
            n, of = counted(s)
            if n >= 9 and n / of >= 0.6 and not any(t < s and want[t][1] >= n / of for t in want):
                want[s] = (n, n / of)
    assert {s: v for s, v in got.items() if len(s) < 3} == want


# --- 7


def test_packing_is_exact(spark):
    rng = random.Random(12)
    topics = [[f"topic{t}word{i}" for i in range(40)] for t in range(6)]
    texts = [" ".join(rng.choices(rng.choice(topics), k=rng.choice([1, 5, 80, 150, 900]))) for _ in range(260)] + [None, "", "same text"] + ["same text"] * 30
    rows = [(i if i % 50 else None, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t, _ in rows:
        want[i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)] += 1
    settings = op7_retrieval_packing.Packing(shard_tokens=20_000)
    got = op7_retrieval_packing.packed(frame, op7_retrieval_packing.rank_file(), packing=settings).collect()
    sequences = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0
    known, loose = {r[0]: r for r in want if r[0] is not None}, defaultdict(list)
    for r in got:
        loose[r.doc_id].append(r)
    for i, pieces in loose.items():
        if i is None:
            assert sum(r.length for r in pieces) == sum(len(ids) * n for (k, ids), n in want.items() if k is None)
            continue
        pieces.sort(key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist()
        assert tuple(ids) == known[i][1] and all(r.doc_tokens == len(ids) for r in pieces)
        assert [r.start for r in pieces] == list(itertools.accumulate([0, *[r.length for r in pieces[:-1]]]))
    assert set(known) <= set(loose)
    stage = op7_retrieval_packing.stage(spark, frame, "").where("doc_id = 1").first()
    assert stage.ids_crc32 == zlib.crc32(np.array(known[1][1][: stage.length] if not stage.start else known[1][1][stage.start : stage.start + stage.length], "<u4").tobytes())
    assert op7_retrieval_packing.packed(frame.limit(0), op7_retrieval_packing.rank_file()).count() == 0


def test_added_tokens_have_the_ids_of_the_library(spark):
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"tail  {end}  head\n", "<|endoftext| >", f"one{end}", f"{end} two", "<|endoftext", "plain"] + [f"w{i} {end} x{i}" for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = defaultdict(list)
    for r in op7_retrieval_packing.packed(frame, op7_retrieval_packing.rank_file()).collect():
        found[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in sorted(found[i], key=lambda r: r.start)), "<u4").tolist()
        assert ids == [*library.encode(t, add_special_tokens=False).ids, 0] and all(r.doc_tokens == len(ids) for r in found[i]), t


def test_different_and_rarest_ids():
    rng, places = np.random.default_rng(7), np.full(60, 5, np.int32)
    for n in (0, 1, 2, 3, 50, 400):
        for top in (1, 2, 60):
            ids = rng.integers(0, top, n).astype("<u2")
            kinds = np.unique(ids).tolist()
            assert sorted(op7_retrieval_packing.different(ids, places).tolist()) == kinds
            assert op7_retrieval_packing.rarest(ids) == (kinds[-1] << 16 | kinds[-2:][0] if kinds else 0)


def test_neighbours_by_brute_force():
    rng, packing = np.random.default_rng(1), op7_retrieval_packing.Packing()
    docs = [np.append(rng.integers(100 * (d % 4) + 1, 100 * (d % 4) + 60, rng.integers(1, 90)), 0).astype("<u2") for d in range(200)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=500)
    idf = np.log1p((200 - df + 0.5) / (df + 0.5)).astype(np.float32)
    index = op7_retrieval_packing.Index(docs, idf, 51.0, packing)
    free = np.ones(200, np.int8)
    free[8] = 0

    def bm25(query, doc):
        found, n = 0.0, Counter(doc[:-1].tolist())
        for t in set(query[:-1].tolist()) & set(n):
            found += float(idf[t]) * n[t] * (packing.k1 + 1) / (n[t] + packing.k1 * (1 - packing.b + packing.b * len(doc) / 51.0))
        return found

    for seed in (4, 5, 77):
        want = {d: bm25(docs[seed], x) for d, x in enumerate(docs)}
        got = list(index.neighbours(seed, free))
        assert sorted(got) == sorted(d for d, x in want.items() if x and d != 8) and 8 not in got
        assert all(want[a] >= want[b] - 1e-4 for a, b in itertools.pairwise(got))
        assert [d % 4 for d in got] == [seed % 4] * len(got)


# --- 10


def dropped(rows, limits):
    pages, total = Counter(), Counter()
    for host, text in rows:
        total[host] += 1
        for line in {x.strip(" \t\r\x0b\x0c") for x in text.split("\n")} if text is not None else ():
            pages[host, line] += 1
    gone = {k for k, n in pages.items() if k[1] and n >= limits.min_pages and n > limits.ratio * total[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" \t\r\x0b\x0c")) not in gone) for h, t in rows]


@pytest.mark.parametrize("most", [50_000, 0])
def test_lines_by_brute_force(spark, most):
    rng = random.Random(7)
    lines = [f"line {i}" for i in range(60)] + ["  menu  ", "menu", "", " ", "menu\r"]
    rows = [(rng.choice(["a", "b", "b", "b", None]), "\n".join(rng.choices(lines, k=rng.randint(0, 12)))) for _ in range(300)] + [("a", None), (None, None), ("c", "menu"), ("c", "menu\n\n")]
    limits = op10_line_frequency.Boilerplate(ratio=0.15, min_pages=3, broadcast_lines=most)
    frame = spark.createDataFrame([(i, h, t, "x", "y") for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string, host string, gone string")
    got = op10_line_frequency.drop_lines(frame, limits=limits, dropped="n").orderBy("doc_id").collect()
    want = dropped(rows, limits)
    assert [r.text for r in got] == want and any(r.n for r in got)
    assert all(r.n == (0 if t is None else len(t.split("\n")) - (len(w.split("\n")) if w or t == "" else 0)) or w == "" for r, (_, t), w in zip(got, rows, want, strict=True))
    assert op10_line_frequency.drop_lines(frame.limit(0), limits=limits).columns == frame.columns


def test_a_large_group_of_copies_reaches_packing(spark):
    body = "\n".join(f"sentence {i} of the copied text" for i in range(8))
    texts = [body] * 40 + [f"own text {i}\nmenu\nmore of {i}" for i in range(100)] + [None, None]
    frame = spark.createDataFrame([(i, t, "en", "site", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    lines = op10_line_frequency.stage(spark, frame, "")
    got = {r.doc_id: r for r in lines.collect()}
    assert len(got) == len(texts) and all(got[i].text == body and got[i].n_chars == len(body) for i in range(40))
    assert all(got[40 + i].text == f"own text {i}\nmore of {i}" for i in range(100)) and got[140].text is None
    pieces = op7_retrieval_packing.stage(spark, op2_order_minhash.stage(spark, lines, ""), "").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_tokens for r in pieces if r.doc_id == 0} == {len(library.encode(body, add_special_tokens=False).ids) + 1}
    assert not any(0 < r.doc_id < 40 for r in pieces)
    host = op10_line_frequency.drop_lines(frame, copies=False, limits=op10_line_frequency.Boilerplate(broadcast_lines=0))
    assert {r.doc_id: r.text for r in host.collect()} == {i: r.text for i, r in got.items()}
