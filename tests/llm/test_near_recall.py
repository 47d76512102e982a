"""Order MinHash: how many links and merges are found where edits are scattered, against exhaustive comparison."""

import itertools
import random
import uuid
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from millrace.llm import op2_order_minhash as near_dups

RNG = random.Random(21)
WORDS = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(2, 8))) for _ in range(8000)]


def edited(words, share, rng):
    """Words replaced, dropped and inserted at random places."""
    out = []
    for w in words:
        if rng.random() >= share:
            out.append(w)
        elif (kind := rng.random()) < 0.6:
            out.append(rng.choice(WORDS))
        elif kind < 0.8:
            out += [w, rng.choice(WORDS)]
    return out


def replaced(words, share, rng):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("change", "each"), [(replaced, 1.0), (edited, 1.15)])
@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_links_share_a_band(similarity, change, each):
    rng, near, found, links = random.Random(int(100 * similarity)), near_dups.Near(), 0, 0
    while links < 150:
        a = rng.choices(WORDS, k=rng.randint(80, 400))
        x, y = (near_dups.word_hashes(" ".join(t)) for t in (a, change(a, each * (1 - similarity), rng)))
        share = 2 * near_dups.common(x.tolist(), y.tolist(), len(x) + len(y)) / (len(x) + len(y))
        if similarity <= share < similarity + 0.03:
            links += 1
            found += (near_dups.sketches(near_dups.labelled(near_dups.kmers(x, 5)), near) == near_dups.sketches(near_dups.labelled(near_dups.kmers(y, 5)), near)).any()
    assert found >= 0.9 * links


def test_a_repeated_passage_leaves_the_other_labels_alone():
    once = near_dups.word_hashes(" ".join(WORDS[:50]))
    twice = np.concatenate([once, once[:6]])
    for of in (lambda x: x, lambda x: near_dups.kmers(x, 5)):
        assert set(near_dups.labelled(of(once)).tolist()) < set(near_dups.labelled(of(twice)).tolist())


def classes_by_brute_force(texts, similarity=0.8):
    hashes = [near_dups.word_hashes(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if root(a) != root(b) and near_dups.alignment(hashes[a], hashes[b], similarity):
            parent[root(a)] = root(b)
    return len({root(i) for i in range(len(texts))})


@pytest.mark.parametrize("copies", [150, 300])
def test_a_group_of_far_copies_is_merged(spark, copies):
    rng = random.Random(copies)
    base = rng.choices(WORDS, k=60)
    texts = [" ".join(rng.choice(WORDS) if rng.random() < 0.11 else w for w in base) for _ in range(copies)]
    got = near_dups.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found, true = len({r.class_id for r in got}), classes_by_brute_force(texts)
    assert len(got) == copies and copies - found >= 0.95 * (copies - true)  # of the merges


def merged_by_brute_force(texts, near):
    """Sets of texts that links tie between texts that agree in a band."""
    hashes = [near_dups.word_hashes(t) for t in texts]
    bands = [set(near_dups.sketches(near_dups.labelled(near_dups.kmers(h, near.words)), near).tolist()) for h in hashes]
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if label[a] != label[b] and bands[a] & bands[b] and near_dups.alignment(hashes[a], hashes[b], near.similarity):
            label = [label[a] if x == label[b] else x for x in label]
    return {frozenset(i for i, x in enumerate(label) if x == y) for y in set(label)}


@pytest.mark.parametrize("block", [1024, 16])
def test_no_link_of_a_large_bucket_is_lost(spark, block):
    """Each text has a third of one passage and what ties it to its neighbours in a chain, so that the first text of a bucket ties some away from others."""
    rng, near = random.Random(11), near_dups.Near(bands=8, small=4, rounds=1, block=block)
    passage, tail = rng.choices(WORDS, k=40), rng.choices(WORDS, k=60)
    texts = []
    for _ in range(120):
        for at in rng.sample(range(60), 11):
            tail[at] = rng.choice(WORDS)
        texts.append(" ".join(passage + tail))
    rng.shuffle(texts)
    groups = defaultdict(set)
    for r in near_dups.classes(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", near=near).collect():
        groups[r.class_id].add(r.id)
    assert set(map(frozenset, groups.values())) == merged_by_brute_force(texts, near)


def test_a_text_meets_the_nearest_of_a_class_first(spark, monkeypatch):
    """Texts at the edge of a group of copies have links to few or many of it: one ties them, and those that have none are told by their words, not by alignments with all of the group."""
    rng, near, aligned, links_of = random.Random(4), near_dups.Near(bands=16, small=4, rounds=1), [], near_dups.links_of
    base = rng.choices(WORDS, k=60)
    texts = [" ".join(replaced(base, 0.06 if i < 150 else 0.16, rng)) for i in range(190)]
    monkeypatch.setattr(near_dups, "links_of", lambda pairs, *rest: aligned.append(pairs.count()) or links_of(pairs, *rest))
    groups = defaultdict(set)
    for r in near_dups.classes(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", near=near).collect():
        groups[r.class_id].add(r.id)
    assert set(map(frozenset, groups.values())) == merged_by_brute_force(texts, near)
    assert aligned[-1] <= 10 * 40


def test_a_group_of_copies_is_not_read_anew_for_each_bucket(spark, monkeypatch, tmp_path):
    """Texts at the edge of a group of copies share many buckets with it: its texts come to the blocks once, and no split begins without texts."""
    rng, near, blocks, split, empty = random.Random(4), near_dups.Near(bands=16, small=4, rounds=1), near_dups.possible_pairs, near_dups.split, []
    base = rng.choices(WORDS, k=60)
    texts = [" ".join(replaced(base, 0.06 if i < 150 else 0.16, rng)) for i in range(190)]

    def counted(near, most):
        pairs = blocks(near, most)

        def seen(block):
            (tmp_path / uuid.uuid4().hex).write_text(str(len(block)))
            return pairs(block)

        return seen

    monkeypatch.setattr(near_dups, "possible_pairs", counted)
    monkeypatch.setattr(near_dups, "split", lambda members, *rest: empty.append(members.isEmpty()) or split(members, *rest))
    groups = defaultdict(set)
    for r in near_dups.classes(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", near=near).collect():
        groups[r.class_id].add(r.id)
    assert set(map(frozenset, groups.values())) == merged_by_brute_force(texts, near)
    rows = sum(int(f.read_text()) for f in tmp_path.iterdir())
    assert 0 < rows <= 2 * len(texts), rows
    assert not any(empty)


@pytest.mark.parametrize("most", [0, 2])
def test_pairs_of_a_block(most):
    """All pairs of texts that have enough words in common, or the nearest of each class and word of the others."""
    rng, near = random.Random(9), near_dups.Near()
    base = rng.choices(WORDS, k=40) * 2
    hashes = [near_dups.word_hashes(" ".join(replaced(base, 0.1 * (i % 3), rng))) for i in range(30)]
    sets = [np.sort((near_dups.labelled(h) >> np.uint64(32)).astype(np.uint32)) for h in hashes]
    side = pd.DataFrame({"id": range(30), "n": [len(h) for h in hashes], "label": [i // 6 for i in range(30)], "main": 0, "tally": [near_dups.tally(h, near.bins) for h in hashes], "words": [s.tobytes() for s in sets]})
    got = near_dups.possible_pairs(near, most)(pd.concat([side[side["label"] > 0].assign(first=True), side.assign(first=False)]))
    want, more = set(), False
    for i in range(6, 30):
        for label in range(5):
            fit = [(160 - 2 * len(np.intersect1d(sets[i], sets[j])), j) for j in range(6 * label, 6 * label + 6) if label != i // 6 and (label == 0 or j > i)]
            fit = sorted(x for x in fit if x[0] <= 0.2 * 160)
            want |= {(min(i, j), max(i, j)) for _, j in (fit[:most] if most else fit)}
            more |= bool(most) and len(fit) > most
    assert set(zip(got["a"], got["b"], strict=True)) == want and got["more"].any() == more == bool(most)


def test_texts_that_share_a_passage_are_no_copies_and_do_not_hide_them(spark):
    """Half of each text is one passage: its bands hold all texts, which no round ties; the copies among them are found."""
    rng = random.Random(5)
    passage = rng.choices(WORDS, k=60)
    texts = [rng.choices(WORDS, k=30) + passage + rng.choices(WORDS, k=30) for _ in range(150)]
    copies = [edited(t, 0.05, rng) for t in texts[:40]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts + copies)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for near in (near_dups.Near(), near_dups.Near(small=4, rounds=1)):
        groups = defaultdict(set)
        for r in near_dups.classes(frame, near=near).collect():
            groups[r.class_id].add(r.id)
        pairs = {frozenset(g) for g in groups.values() if len(g) > 1}
        assert pairs <= {frozenset({i, 150 + i}) for i in range(40)} and len(pairs) >= 38


def test_clashing_names_long_texts_and_rows_without_links(spark):
    long = " ".join(RNG.choices(WORDS, k=60_000))
    rows = [(1, long, "x", 1), (2, long + " tail", "y", 2), (3, "alone", "z", 3), (4, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, label int")
    kept = near_dups.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert near_dups.drop_near_duplicates(frame.where("doc_id > 2")).count() == 2


def test_counts_of_words_exclude_no_link():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.choices(WORDS[:200], k=rng.randint(1, 300))
        x, y = (near_dups.word_hashes(" ".join(t)) for t in (a, edited(a, 0.2, rng)))
        apart = np.abs(np.frombuffer(near_dups.tally(x, 128), np.uint8).astype(int) - np.frombuffer(near_dups.tally(y, 128), np.uint8)).sum()
        if near_dups.alignment(x, y, 0.8):
            assert apart <= 0.2 * (len(x) + len(y)) + 1e-6
