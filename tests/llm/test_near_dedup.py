import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import numpy as np

from tallywell.llm.near_dedup import (
    _components, _crowded, _joined, bag_of, banded_distance, block_pairs, keep_one, may_link, near_classes, similar, sketches_of,
)
from tallywell.llm.words import normal_text, words_of


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def test_banded_distance_matches_brute_force():
    rng = random.Random(3)
    for _ in range(4000):
        k = rng.choice((2, 3, 20))
        a = [rng.randrange(k) for _ in range(rng.randrange(14))]
        b = [rng.randrange(k) for _ in range(rng.randrange(14))] if rng.random() < 0.5 else list(a)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(k)] * rng.randrange(2)
        d = distance(a, b)
        for most in range(8):
            assert banded_distance(a, b, most) == min(d, most + 1)
        assert similar(a, b) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def classes_of(rows, links):
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in rows}


def shingle_similarity(a, b):
    def bag(words):
        seen = defaultdict(int)
        out = set()
        for i in range(max(1, len(words) - 4)):
            gram = tuple(words[i : i + 5])
            out.add((gram, seen[gram]))
            seen[gram] += 1
        return out

    x, y = bag(a), bag(b)
    return len(x & y) / len(x | y)


def test_driver_documents_match_brute_force(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    words = {i: normal_text(t.encode()).split() for i, t in rows.items()}
    got = {r.doc_id: r.class_id for r in near_classes(documents).collect()}
    ids = sorted(rows)
    sure, possible = [], []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if rows[a] == rows[b] or similar(words[a], words[b]):
                possible.append((a, b))
                if rows[a] == rows[b] or shingle_similarity(words[a], words[b]) >= 0.8:
                    sure.append((a, b))
    assert sure
    assert all(got[a] == got[b] for a, b in sure)  # none of these may be missed
    widest = classes_of(ids, possible)
    assert all(widest[i] == widest[c] for i, c in got.items())  # nothing else is joined
    assert sum(got[a] == got[b] for a, b in possible) >= 0.9 * len(possible)


def edited(words, rate, rng, vocabulary):
    words = list(words)
    for at in rng.sample(range(len(words)), int(rate * len(words))):
        words[at] = rng.choice(vocabulary)
    return words


def test_large_groups_and_shared_passages(spark):
    """Copies, near copies of one text, and texts that only share a passage of over 50 words."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, want = [], {}
    for i in range(150):
        rows.append((i, " ".join(base if i < 60 else edited(base, 0.02, rng, vocabulary))))
        want[i] = 0
    for i in range(150, 350):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        rows.append((i, " ".join(own[:30] + passage + own[30:])))
        want[i] = i
    for i in range(350, 400):
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 40)))))
        want[i] = i
    texts = defaultdict(list)
    for i, t in rows:
        texts[t].append(i)
    want = {i: min(want[j] for j in texts[t]) for i, t in rows}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_classes(frame).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    assert all((r.n_links > 0) == (r.doc_id < 150) for r in got)
    kept = keep_one(frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_copies_inside_a_large_template_group(spark):
    """Texts that share 70 % and are unlike, with edited copies among them: similar texts of a bucket are connected."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(5000)]
    template = [rng.choice(vocabulary) for _ in range(140)]
    texts = []
    for _ in range(300):
        own = template + [rng.choice(vocabulary) for _ in range(60)]
        texts += [own, edited(own, 0.1, rng, vocabulary)]
    rng.shuffle(texts)
    sketches = [set(_sketches_of(" ".join(t))) for t in texts]
    sure = [
        (i, j) for j in range(600) for i in range(j)
        if sketches[i] & sketches[j] and similar(texts[i], texts[j])
    ]
    assert len(sure) >= 200
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_classes(frame).collect()}
    assert all(got[i] == got[j] for i, j in sure)
    widest = classes_of(range(600), [(i, j) for j in range(600) for i in range(j) if similar(texts[i], texts[j])])
    assert all(widest[i] == widest[c] for i, c in got.items())


def _sketches_of(text):
    return sketches_of(words_of([text.encode()]).hash).tolist()


def hashes(words):
    return words_of([" ".join(words).encode()]).hash


def test_blocks_hold_all_links():
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    texts = [edited(rng.choice(base), rng.choice((0.05, 0.1, 0.2)), rng, vocabulary) for _ in range(80)]
    for text in texts[::3]:
        del text[rng.randrange(len(text))]
    rows = [(i, i % 5, len(t), bag_of(hashes(t)).tobytes()) for i, t in enumerate(texts)]
    for first in (0, 30):
        want = {
            (i, j) for j in range(80) for i in range(j)
            if i % 5 != j % 5 and similar(texts[i], texts[j]) and not (first and (i < first) == (j < first))
        }
        got = set(block_pairs(rows, first))
        assert want <= got and len(got) < 1000
        assert all(i % 5 != j % 5 and not (first and (i < first) == (j < first)) for i, j in got)


def test_bags_bound_the_distance():
    rng = random.Random(5)
    for _ in range(2000):
        k = rng.choice((3, 30, 3000))
        a = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(14)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [f"w{rng.randrange(k)}"] * rng.randrange(2)
        apart = np.abs(bag_of(hashes(a)).astype(int) - bag_of(hashes(b))).sum()
        if similar(a, b):
            assert may_link(np.array([len(a)]), np.array([len(b)]), np.array([apart]))[0]
    long = ["x"] * 5000
    assert bag_of(hashes(long)).max() == 255


def test_sketches_tell_the_order():
    """Blocks of 40 words in another order: nearly all shingles are the same, but not their order."""
    rng = random.Random(2)
    moved, reversed_ = [], []
    for k in range(20):
        words = [f"{k}w{i}" for i in range(400)]
        parts = [words[i : i + 40] for i in range(0, 400, 40)]
        own = set(sketches_of(hashes(words)).tolist())
        for kept, order in ((moved, rng.sample(parts, 10)), (reversed_, parts[::-1])):
            kept.append(len(own & set(sketches_of(hashes(sum(order, []))).tolist())) / len(own))
    assert np.mean(moved) < 0.65 and np.mean(reversed_) < 0.2


@pytest.mark.parametrize("rate", [0.05, 0.1, 0.15, 0.2])
def test_recall_of_scattered_edits(spark, rate):
    rng = random.Random(19)
    rows = []
    for i in range(600):
        size = rng.choice((5, 8, 15, 30, 38, 42, 60, 100, 300))
        words = [f"{i}x{k}" for k in range(size)]
        rows.append((2 * i, " ".join(words)))
        other = list(words)
        for at in rng.sample(range(size), int(rate * size)):
            other[at] = f"{i}y{at}"
        rows.append((2 * i + 1, " ".join(other)))
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    classes = {r.doc_id: r.class_id for r in got}
    assert sum(classes[2 * i] == classes[2 * i + 1] == 2 * i for i in range(600)) >= 0.99 * 600
    assert len(set(classes.values())) >= 600


@pytest.mark.parametrize("edges", [
    [], [(1, 0)], [(i + 1, i) for i in range(200)], [(0, i) for i in range(1, 100)] + [(200, 201), (201, 202)],
    [(5, 9), (9, 7), (3, 7), (100, 101), (101, 100)],
])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "one long, two long")
    got = {r.node: r.root for r in _components(frame).collect()}
    nodes = {x for e in edges for x in e}
    want = classes_of(sorted(nodes), edges)
    assert got == {n: r for n, r in want.items() if n != r}


def test_odd_rows(odd, none):
    rows = near_classes(odd).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in rows) == sorted([
        (1, 1), (1, 1), (2, 2), (3, 2), (4, 4), (-1, -1), (-1, 2), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9), (9, 9),
    ])
    kept = keep_one(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4, 5, 7, 8, 9]
    assert near_classes(none).count() == 0 and keep_one(none).count() == 0


def test_all_copies(spark):
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text in every document here").alias("text"))
    assert near_classes(frame).select("class_id", "n_links").distinct().collect() == [(0, 0)]
    assert [r.doc_id for r in keep_one(frame).collect()] == [0]


def test_crowded_pairs_are_dealt_in_tiles(spark):
    """300 texts that may all be links, in two buckets: each pair is in one tile, and far fewer rows than pairs leave the blocks."""
    bag = bytes(bag_of(hashes([f"w{i}" for i in range(90)])).tobytes())
    members = [(b, i, 90, 0 if i < 100 else i) for b in (1, 2) for i in range(300)]
    frame = spark.createDataFrame(members, "bucket long, node long, n long, root long")
    bags = spark.createDataFrame([(i, 90, bag) for i in range(300)], "node long, n long, bag binary")
    rows = _crowded(frame, bags, 0.8).collect()
    got = [(min(r.node, p), max(r.node, p)) for r in rows for p in r.partners]
    assert sorted(got) == [(i, j) for i in range(300) for j in range(max(i + 1, 100), 300)]
    assert len(rows) < len(got) / 10
    held = {(r.bucket, r.kind, r.low, r.x, r.y, r.tile, r.node) for r in rows}
    assert len(held) == len(rows) and all((*r[:6], p) in held for r in rows for p in r.partners)


def test_joined_roots(spark):
    first, second = [(1, 0), (2, 0), (5, 4), (8, 7)], [(2, 5), (6, 8), (10, 11)]
    edges = lambda rows: spark.createDataFrame(rows, "one long, two long")
    got = {r.node: r.root for r in _joined(_components(edges(first)), edges(second)).collect()}
    assert got == {1: 0, 2: 0, 4: 0, 5: 0, 7: 6, 8: 6, 11: 10}
