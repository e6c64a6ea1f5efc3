from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallywell.llm.mixing import mix_sources, n_words, size_documents, source_targets, take_documents


def reshared(sizes, times=3):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(times * sizes[s] for s in full)
        rest = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > times * sizes[s]}
        if not over:
            return {**{s: times * sizes[s] for s in full}, **share}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10}, {"a": 5, "b": 1000, "c": 3, None: 700}, {"a": 1, "b": 1, "c": 1}, {"a": 0, "b": 4}, {None: 0}, {},
    {f"s{i}": (i * 37) % 101 for i in range(40)}, {"z": 1, "Z": 10_000, "é": 2, "\U0001f600": 3},
])
def test_targets_are_reshared(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = reshared(sizes) if sizes else {}
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_words(spark, odd):
    import re

    rows = odd.select("text", n_words(F.col("text")).alias("n")).collect()
    assert [r.n for r in rows] == [len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in rows]


def test_mix_comes_near_the_targets(documents):
    rows = mix_sources(size_documents(documents)).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in target)


def test_taken_documents_and_reruns(documents):
    want = {r.doc_id: r.copies for r in mix_sources(size_documents(documents)).collect()}
    got = defaultdict(int)
    for r in take_documents(documents).collect():
        got[r.doc_id] += 1
    assert got == {d: c for d, c in want.items() if c}
    again = mix_sources(size_documents(documents.repartition(5))).collect()
    assert {r.doc_id: r.copies for r in again} == want


def test_odd_rows(odd, none):
    rows = mix_sources(size_documents(odd)).collect()
    assert len(rows) == odd.count()
    mixed = take_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mix_sources(size_documents(none)).count() == 0 and take_documents(none).count() == 0
