import math
from collections import Counter

import numpy as np
import pytest

from tallywell.llm import lexical
from tallywell.llm.lexical import DocumentTree, rank_documents, terms_of
from tallywell.session import table

SF_DIR = "/root/testdata/sf0.001"


def brute(docs, items, most=10):
    """docs, items: (id, text)."""
    counted = [(i, Counter(terms_of((t or "").encode()))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of((t or "").encode()))
    out = []
    for item, terms in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in terms}
        found = []
        for i, c in counted:
            if c:
                m = 10 + 90 * sum(c.values()) * n_docs // n_terms
                score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
                found.append((-score, i is None, i or 0, i))
        for k, (score, _, _, i) in enumerate(sorted(f for f in found if f[0] < 0)[:most]):
            out.append((item, k + 1, i, -score))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_terms():
    assert terms_of("Ab_c's Été-9\x7f\x00漢字 ÀB".encode()) == [t.encode() for t in ["ab", "c", "s", "Été", "9", "漢字", "Àb"]]


@pytest.mark.parametrize("item_bytes", [1 << 20, 3000])
def test_whole_tables(spark, documents, item_bytes, monkeypatch):
    items = table(spark, SF_DIR, "benchmark")
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(rank_documents(documents, items, item_bytes=item_bytes)) == want


def test_copies_and_ties(spark):
    """Thousands of equal documents and equal scores: the least doc_ids win, over many blocks and tasks."""
    texts = [(i, "alpha beta gamma" if i % 3 else "alpha beta delta alpha") for i in range(9000, 0, -1)]
    texts += [(10_000 + i, f"word{i} other{i}") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    items = [(1, "Alpha gamma"), (2, "delta word17"), (3, "nothing here"), (4, "beta")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(rank_documents(docs, asked)) == brute(texts, items)


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    rows = [np.unique(np.minimum(rng.zipf(1.4, 20) - 1, 199)) for _ in range(600)]
    rows += [np.arange(150, 170)] * 12  # documents that hold a whole item
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms, tf = np.concatenate(rows), rng.integers(1, 5, bounds[-1])
    m = rng.integers(10, 300, len(rows))
    tree = DocumentTree(list(range(len(rows))), m, bounds, terms, tf, leaf=8)
    weights = np.linspace(6000, 10, 200).astype(np.int64)
    items = [np.arange(150, 170), np.array([0, 3, 9, 40])]
    asked = np.array([sum((x == t).sum() for x in items) for t in range(200)])
    asked = np.concatenate([[0], np.cumsum(asked)])
    askers = np.array([i for t in range(200) for i, x in enumerate(items) if t in x])
    limit = tree.node_bounds(weights, asked, askers, 2)
    assert sorted(tree.doc_ids) == list(range(len(rows)))
    for i, item in enumerate(items):
        scores = [
            sum(weights[t] * (1_000_000_000 * f // (1000 * f + 8 * tree.m[d])) for t, f in zip(
                tree.terms[tree.bounds[d] : tree.bounds[d + 1]], tree.tf[tree.bounds[d] : tree.bounds[d + 1]]) if t in item)
            for d in range(len(rows))
        ]
        for node in range(len(tree.first)):
            assert limit[i, node] >= max(scores[tree.first[node] : tree.last[node]])
    tenth = sorted(scores_of(tree, weights, items[0]))[-10]
    leaves = [n for n, c in enumerate(tree.children) if not c]
    assert sum(limit[0, n] >= tenth for n in leaves) < len(leaves) / 4


def scores_of(tree, weights, item):
    held = np.isin(tree.terms, item) * weights[tree.terms] * tree.gain
    return np.add.reduceat(held, tree.bounds[:-1]).tolist()


def test_odd_rows(spark, odd, none):
    items = [(1, "line LENGTH second"), (1, "fox"), (1, "fox"), (2, None), (3, ""), (4, "... !"), (None, "short été"), (5, "x" * 300_000)]
    asked = spark.createDataFrame([(i, t, "en", -1.0) for i, t in items], "item_id long, text string, lang string, score double")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(rank_documents(odd, asked)) == brute(rows, items)
    assert got(rank_documents(none, asked)) == []
    assert got(rank_documents(odd, asked.where("false"))) == []
    assert lexical.length_factor(0, 5, 10) == 10
