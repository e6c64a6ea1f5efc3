import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import line_dedup
from tallywell.llm.line_dedup import build_filter, build_index, dedup_lines, delete_documents, has_keys, insert_documents, remove_keys

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    def key(line):
        line = line.strip(WHITE)
        line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return line if len(line) >= 10 else None

    end = float("inf")
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(end if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = end if doc is None else doc
        kept = [x for x in lines if key(x) is None or len(held[key(x)]) < 2 or min(held[key(x)]) == own]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(lines), len(lines) - len(kept), sha))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("n", [0, 1, 5, 300, 20_000])
def test_filter_has_no_false_negatives(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    cells = build_filter(keys)
    assert has_keys(cells, keys).all()
    others = np.random.default_rng(99).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert has_keys(cells, others).mean() < 0.002
    remove_keys(cells, keys[: n // 2])
    assert has_keys(cells, keys[n // 2 :]).all()
    if n:
        remove_keys(cells, keys[n // 2 :])
    assert not cells.any()


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_driver_documents_match_brute_force(documents, filter_bytes):
    want = brute([(r.doc_id, r.text) for r in documents.collect()])
    assert any(n for _, _, n, _ in want)
    assert rows_of(dedup_lines(documents, filter_bytes=filter_bytes)) == want


def test_insertions_and_deletions_are_reversible(spark, documents):
    old, new = documents.where("doc_id % 3 > 0"), documents.where("doc_id % 3 = 0")
    index = insert_documents(build_index(old, keys_per_shard=20), new, keys_per_shard=20)
    assert index.shards > 1
    everything = rows_of(dedup_lines(documents))
    assert rows_of(dedup_lines(documents, index)) == everything
    back = delete_documents(index, new.select("doc_id"))
    assert rows_of(dedup_lines(old, back)) == rows_of(dedup_lines(old))
    assert rows_of(back.counts.select("a", "b", "refs", "first", "last")) == rows_of(build_index(old).counts.select("a", "b", "refs", "first", "last"))
    again = insert_documents(back, new)
    assert rows_of(dedup_lines(documents, again)) == everything


def test_kept_text(documents):
    for r in dedup_lines(documents, keep_text=True).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_odd_rows(odd, none):
    assert rows_of(dedup_lines(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert dedup_lines(none).count() == 0


def test_a_line_in_all_documents(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("The SAME line \nown line "), "id").alias("text"))
    rows = dedup_lines(docs).collect()
    assert sorted(r.doc_id for r in rows if r.n_dropped == 0) == [0] and all(r.n_lines == 2 for r in rows)
