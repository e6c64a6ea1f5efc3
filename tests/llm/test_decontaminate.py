import random

import numpy as np
import pytest

from tallywell.llm.decontaminate import Matcher, drop_contaminated, find_items
from tallywell.llm.words import normal_text
from tallywell.session import table

SF_DIR = "/root/testdata/sf0.001"


def least_distance(item, words):
    """Edit distance of ``item`` to the nearest stretch of ``words``, cell by cell."""
    above = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        row = [i]
        for j, y in enumerate(words, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return min(above)


def least_distances(items, words):
    """The same for many items, one word of the text at a time, vectorised over the items' cells."""
    out = []
    for item in items:
        codes = {w: i for i, w in enumerate(dict.fromkeys(item))}
        a = np.array([codes[w] for w in item])
        cell, best = np.arange(len(a) + 1), len(a)
        steps = np.arange(len(a) + 1)
        for word in words:
            miss = np.concatenate([[0], (a != codes.get(word, -1))])
            new = np.minimum(cell + 1, np.concatenate([[0], cell[:-1] + miss[1:]]))
            new[0] = 0
            cell = np.minimum.accumulate(new - steps) + steps
            best = min(best, int(cell[-1]))
        out.append(best)
    return out


def test_distance_matches_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        vocabulary = [f"w{i}" for i in range(rng.choice((3, 30)))]
        item = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 20))]
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]
        matcher = Matcher([" ".join(item).encode()])
        from tallywell.llm.words import words_of

        found = words_of([" ".join(text).encode()]).hash.tolist()
        assert matcher.distance(0, found) == least_distance(item, text)


def test_driver_documents_match_brute_force(spark, documents):
    items = table(spark, SF_DIR, "benchmark")
    got = {(r.doc_id, r.item_id): r.distance for r in find_items(documents, items).collect()}
    names = [r.item_id for r in items.collect()]
    words = [normal_text(r.text.encode()).split() for r in items.collect()]
    want = {}
    for r in documents.collect():
        text = normal_text(r.text.encode()).split()
        held = set(text)
        near = [i for i, w in enumerate(words) if sum(x in held for x in w) >= 0.8 * len(w)]
        for i, d in zip(near, least_distances([words[i] for i in near], text)):
            if d <= int(0.2 * len(words[i]) + 1e-9):
                want[r.doc_id, names[i]] = d
    assert want and set(got) <= set(want)
    assert len(got) >= 0.9 * len(want)
    assert {k for k, d in want.items() if d == 0} <= set(got)
    assert all(got[k] == want[k] for k in got)


@pytest.mark.parametrize("rate, recall", [(0.0, 1.0), (0.05, 0.98), (0.1, 0.97), (0.2, 0.9)])
def test_recall_of_edited_passages(spark, documents, rate, recall):
    rng = random.Random(7)
    items = [r.text.encode() for r in table(spark, "/root/testdata/sf0.1", "benchmark").orderBy("item_id").collect()]
    vocabulary = " ".join(r.text for r in documents.limit(50).collect()).encode().split()
    texts = []
    for item in items:
        words = item.split()
        for at in rng.sample(range(len(words)), int(rate * len(words))):
            words[at] = rng.choice(vocabulary)
        around = [b" ".join(rng.choice(vocabulary) for _ in range(70)) for _ in range(2)]
        texts.append(around[0] + b" " + b" ".join(words) + b"\n" + around[1])
    found = {(t, i) for t, i, *_ in Matcher(items).matches(texts)}
    assert sum((i, i) in found for i in range(len(items))) >= recall * len(items)


@pytest.mark.parametrize("size", [5, 20, 60, 200, 1000])
@pytest.mark.parametrize("rate", [0.05, 0.2])
@pytest.mark.parametrize("kind", ["substituted", "inserted", "deleted"])
def test_recall_at_any_length(size, rate, kind):
    rng = random.Random(23)
    items = [[f"i{j}w{k}" for k in range(size)] for j in range(20 if size == 1000 else 60)]
    texts = []
    for item in items:
        words = list(item)
        for at in sorted(rng.sample(range(size), int(rate * size)), reverse=True):
            words[at : at + (kind != "inserted")] = [] if kind == "deleted" else [f"z{rng.random()}"]
        around = [[f"a{rng.random()}" for _ in range(30)] for _ in range(2)]
        texts.append(" ".join(around[0] + words + around[1]).encode())
    found = {(t, i) for t, i, *_ in Matcher([" ".join(x).encode() for x in items]).matches(texts)}
    assert sum((i, i) in found for i in range(len(items))) >= 0.93 * len(items)


def test_case_punctuation_and_neighbours():
    item = b"Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu."
    texts = [b"x " + item.upper().replace(b" ", b"\n"), b"alpha beta gamma", b"", item + b" " + item, b"beta gamma " * 10]
    found = Matcher([item, b"too short", b""]).matches(texts)
    assert [(t, i, d) for t, i, d, _ in found] == [(0, 0, 0), (3, 0, 0)]


def test_items_under_five_words_are_found_exactly():
    paragraph = "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u3002" * 4
    items = ["Four words, of test", "one", "x y", paragraph, "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35 abc", "x y", ""]
    texts = [
        "here four words of TEST stand", "four words of", "x", "y one x. y", "\u524d\u6587" + paragraph[:9] + "\n" + paragraph[9:] + "\u5f8c",
        paragraph[1:], "z \u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35abc", "one one",
    ]
    found = Matcher([t.encode() for t in items]).matches([t.encode() for t in texts])
    assert sorted(found) == [(0, 0, 0, 1), (3, 1, 0, 1), (3, 2, 0, 2), (3, 5, 0, 2), (4, 3, 0, 0), (6, 4, 0, 1), (7, 1, 0, 0)]


def test_item_blocks_find_the_same(spark, documents):
    items = table(spark, SF_DIR, "benchmark")
    whole = {tuple(r) for r in find_items(documents, items).collect()}
    assert {tuple(r) for r in find_items(documents, items, item_bytes=2000).collect()} == whole


def test_odd_rows(spark, odd, none):
    schema = "item_id long, text string, distance int"
    sentence = "the quick brown fox number 7 jumps over the lazy dog again"
    items = spark.createDataFrame([(1, sentence, 5), (1, sentence, 6), (2, None, 1), (None, sentence, 1), (3, "", None)], schema)
    got = sorted(((r.doc_id, r.item_id or 0, r.distance) for r in find_items(odd, items).collect()))
    assert got == [(5, 0, 0), (5, 1, 0), (6, 0, 0), (6, 1, 0)]
    clean = drop_contaminated(odd, items)
    assert clean.columns == odd.columns and clean.schema == odd.schema
    assert clean.count() == odd.count() - 2
    assert find_items(none, items).count() == 0 and drop_contaminated(none, items).count() == 0
    assert find_items(odd, spark.createDataFrame([], schema)).count() == 0
    assert drop_contaminated(odd, spark.createDataFrame([], schema)).count() == odd.count()
