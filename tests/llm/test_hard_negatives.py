import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import hard_negatives
from tallywell.llm.hard_negatives import Anchor, Bucket, mine_negatives, whole_vector

IS_ANCHOR = "vec_id % 100 = 0"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    """rows: vec_id, label, vector of whole numbers."""
    out = []
    for a, label, v in rows:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own == label) for i, own, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fits = [x for x in scored if not x[2] and low * -s <= 100 * -x[0] <= high * -s]
            out.extend((a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits[:negatives]))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<long>")


def got(found):
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(rng, n, dim, labels, spread):
    centres = rng.normal(size=(labels, dim))
    label = np.where(rng.random(n) < 0.35, 0, rng.integers(0, labels, n))  # a label with over a third of the rows
    v = centres[label] + spread * rng.normal(size=(n, dim))
    v *= rng.lognormal(0, 0.7, n)[:, None]
    return [(i, int(c), np.floor(20 * x).astype(int).tolist()) for i, (c, x) in enumerate(zip(label, v))]


@pytest.mark.parametrize(("dim", "labels", "spread"), [(3, 4, 0.4), (16, 6, 0.5), (16, 900, 1.0), (1, 3, 0.5)])
def test_same_as_brute_force(spark, dim, labels, spread, monkeypatch):
    rng = np.random.default_rng(dim + labels)
    rows = clustered(rng, 2500, dim, labels, spread)
    rows += [(5000 + i, 0, rows[0][2]) for i in range(300)]  # copies: ties
    want = brute(rows)
    assert len(want) > 100
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 100)  # many buckets, slices and blocks
    monkeypatch.setattr(hard_negatives, "SLICE_BUCKETS", 2)
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 10)
    assert got(mine_negatives(frame(spark, rows), IS_ANCHOR)) == want


def test_ranges_keep_all_and_leave_most():
    """Rows at or above a cosine stay; where that is high, most others go before any score is computed."""
    rng = np.random.default_rng(1)
    v = np.floor(200 * rng.normal(size=(4000, 8))).astype(np.int64)
    bucket = Bucket(np.arange(4000), np.zeros(4000, np.int64), v)
    lengths = np.sqrt((v**2).sum(1))
    kept = []
    for i in range(0, 4000, 400):
        anchor = Anchor(i, 0, v[i], [(None, None)], 1)
        cosines = v @ v[i] / lengths / lengths[i]
        for cosine in (0.1, 0.5, 0.8, 0.95):
            own = bucket.candidates(anchor.direction, anchor.focus, cosine)
            assert set(np.flatnonzero(cosines >= cosine)) <= set(own.tolist())
        kept.append(len(own) / 4000)
    assert np.mean(kept) < 0.2
    assert len(bucket.candidates(anchor.direction, anchor.focus, 1.01)) == 0


def test_short_buckets_are_left():
    anchor = Anchor(0, 0, np.array([3, 4]), [(100, None)], 2)
    bucket = Bucket(np.array([1]), np.array([0]), np.array([[2, 2]]))
    bucket.scores = None  # would fail
    anchor.visit(bucket, True)
    assert anchor.best == [[]]


def test_scores_are_exact():
    big = 1 << 30
    bucket = Bucket(np.array([1, 2]), np.zeros(2, np.int64), np.array([[big, 1, big], [big, 0, big]]))
    vector = np.array([big, 1, big])
    assert bucket.scores(np.arange(2), vector, 2.0 * big).tolist() == [2 * big * big + 1, 2 * big * big]
    with pytest.raises(OverflowError):
        Bucket(np.array([1]), np.array([0]), np.array([[1 << 40]])).scores(np.array([0]), np.array([1 << 40]), 2.0**40)


def test_whole_vector(spark):
    rows = [([0.5, -0.001, 1.0],), ([float("nan")],), ([float("inf")],), ([None, 1.0],), (None,), ([],)]
    found = spark.createDataFrame(rows, "v array<float>").select(whole_vector(F.col("v")).alias("v")).collect()
    assert [r.v for r in found] == [[128, -1, 256], None, None, None, None, []]


def test_odd_rows(spark):
    rows = [
        (0, 1, [1, 2]), (0, 1, [1, 2]), (0, 2, [9, 9]), (100, 1, [0, 0]), (200, 3, [5]), (300, None, [1, 1]), (400, 1, None),
        (None, 1, [4, 4]), (500, 1, [None, 1]), (1, 1, [3, 3]), (2, 1, [3, 3]), (3, 2, [1, 2, 3]), (4, 2, []), (5, 2, [-1, -1]),
        (6, 4, [2, 1]), (7, 4, [2, 1]), (7, 4, [2, 1]),
    ]
    clean = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            clean[i] = min(clean.get(i, (label, v)), (label, v))
    want = brute([(i, *row) for i, row in clean.items()])
    extra = frame(spark, rows).withColumn("rank", F.lit(None)).withColumn("score", F.lit("x")).withColumn("v", F.lit(1))
    assert got(mine_negatives(extra, IS_ANCHOR)) == want and want
    assert got(mine_negatives(extra.where("false"), IS_ANCHOR)) == []
    assert got(mine_negatives(extra.where("vec_id = 0"), IS_ANCHOR)) == []
    assert got(mine_negatives(extra, "false")) == []
