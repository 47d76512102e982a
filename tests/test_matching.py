"""Block matching against a plain matcher of longest common blocks."""

import random
from difflib import SequenceMatcher

from millrace.operators import blocks


def plainly(ref, text, block=4):
    found = [b for b in SequenceMatcher(None, ref, text, autojunk=False).get_matching_blocks() if b.size >= block]
    gone = {k for b in found for k in range(b.b, b.b + b.size)}
    return sum(b.size for b in found) / len(ref), " ".join(w for k, w in enumerate(text) if k not in gone), len(found)


def test_blocks_equal_a_plain_matcher(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)]
    refs = {f"r{i}": [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for i in range(6)}
    texts = {}
    for n in range(40):
        words = []
        while len(words) < rng.randint(4, 90):
            source = refs[rng.choice(list(refs))]
            a = rng.randrange(len(source))
            words += source[a : a + rng.randint(1, 25)] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 3))]
        texts[n] = words
    texts |= {100: ["w1"] * 30, 101: ["w1", "w2", "w3"], 102: refs["r0"], 103: refs["r1"] + ["all", "rights", "reserved"] + refs["r1"]}
    refs["rr"] = ["w1"] * 9
    made = blocks.matched(
        spark.createDataFrame([(k, " ".join(w).replace("w1 ", "W1, ")) for k, w in texts.items()] + [(200, None), (201, "")], "text int, t string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in refs.items()], "ref string, t string"),
        ("all rights reserved", "rights"), shortlist=len(refs),
    ).collect()
    got = {(r.text, r.ref): (r.coverage, r.leftover, r.n_blocks) for r in made}
    for t, words in texts.items():
        for r, ref in refs.items():
            want = plainly(ref, words)
            assert got.get((t, r), (0.0, " ".join(words), 0)) == want, (t, r)
    assert {tuple(r.found) for r in made if r.text == 103} == {("all rights reserved", "rights")}
    assert not {200, 201, 101} & {r.text for r in made}


def test_closest_reference_leaves_least(spark):
    refs = spark.createDataFrame([("two", "a b c d e f g h"), ("three", "a b c d e f g h i j k l")], "ref string, t string")
    texts = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "a b c d e f g h x")], "text int, t string")
    best = {r.text: (r.ref, r.leftover) for r in blocks.closest(blocks.matched(texts, refs)).collect()}
    assert best == {1: ("three", ""), 2: ("two", "x")}
    assert blocks.matched(texts.limit(0), refs).count() == 0 and blocks.matched(texts, refs.limit(0)).count() == 0
