import re
from collections import Counter

import numpy as np
import pytest

from tallywell.llm.quality import add_features, fit_votes, keep_good, quality_verdicts
from tallywell.session import table

SF_DIR = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts_match_brute_force(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in quality_verdicts(documents).collect():
        want = brute(texts[r.doc_id])
        assert counts(r) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_long_and_odd_texts(odd, none):
    featured = add_features(odd)
    assert set(odd.columns) <= set(featured.columns)
    for r in featured.collect():
        assert counts(r) == brute(r.text)
    kept = keep_good(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    assert {r.doc_id for r in kept.collect()} <= {1, 5, 6, None}
    assert quality_verdicts(none).count() == 0 and keep_good(none).count() == 0


def test_verdicts_agree_with_labels(spark):
    """Held-out accuracy: the labels are not used by the model."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    joined = quality_verdicts(docs).select("doc_id", "kept", "base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in joined if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in joined if r.quality == 0]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < 0.2


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(60_000) < 0.8
    misses, hits = np.array([0.01, 0.05, 0.02, 0.03, 0.01]), np.array([0.9, 0.5, 0.7, 0.4, 0.6])
    votes = (rng.random((60_000, 5)) >= np.where(good[:, None], misses, hits)).astype(int)
    votes[rng.random(votes.shape) < 0.2] = -1
    patterns, numbers = np.unique(votes, axis=0, return_counts=True)
    model = fit_votes(patterns, numbers.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03)
    for j in range(5):
        assert model.tables[j, 1, 0] == pytest.approx(misses[j], abs=0.03)
        assert model.tables[j, 0, 0] == pytest.approx(hits[j], abs=0.05)
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.95


def test_clean_documents_are_kept_whatever_the_rest():
    """All good votes stay good, also where nothing is bad."""
    for patterns, numbers in (([[1, 1, 1]], [100]), ([[1, 1, 1], [0, 0, 0]], [1, 100]), ([[1, -1, 1], [1, 1, 0]], [50, 50])):
        model = fit_votes(np.array(patterns), np.array(numbers, float))
        assert model.posterior(np.array(patterns[:1]))[0] > 0.5
    assert len(fit_votes(np.zeros((0, 3), int), np.zeros(0)).tables) == 3
