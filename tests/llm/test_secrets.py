import random

import pytest
from pyspark.sql import functions as F

from tallywell.session import table
from tallywell.llm.secrets import find_candidates, frequent_words, scan_secrets

NAMES = ["token", "password", "api_key", "secret"]


def corpus(seed, n):
    """Documents with one finding each, and whether it is a secret."""
    rng = random.Random(seed)
    words = "the lazy dog jumps over quick brown foxes while some other animals sleep near water".split()
    rows = []
    for i in range(n):
        around = " ".join(rng.choice(words) for _ in range(20))
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        kind = i % 5
        if kind == 0:
            rows.append((i, f'{around} {rng.choice(NAMES)} = "{value}" {around}', value, 1))
        elif kind == 1:
            number = "".join(rng.choice("0123456789") for _ in range(16))
            rows.append((i, f"{around} {number} {around}", number, 0))
        elif kind == 2:
            rows.append((i, f"{around} commit {value} {around}", value, 0))
        elif kind == 3:
            name = f"quick.brown{i}.{rng.choice(words)}.example.com"
            rows.append((i, f"{around} user@{name} {around}", name, 0))
        else:
            key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))
            key = "A1" + key
            rows.append((i, f"{around} secret: '{key}' {around}", key, 1))
    return rows


def test_held_out_accuracy(spark):
    labelled = corpus(1, 400)
    held_out = corpus(2, 300)
    rows = [(i, t, "src") for i, t, _, _ in labelled] + [(10_000 + i, t, "src") for i, t, _, _ in held_out]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(f, y) for _, _, f, y in labelled], "finding string, label int")
    got = {(r.doc_id, r.finding): r.is_secret for r in scan_secrets(docs, labels).collect()}
    right = [got[10_000 + i, f] == bool(y) for i, _, f, y in held_out]
    assert sum(right) / len(right) > 0.95


def test_driver_documents(spark):
    documents = table(spark, "/root/testdata/sf0.01", "documents")
    rows = scan_secrets(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert all(r.finding in texts[r.doc_id] for r in rows)
    import re

    tokens = {(d, m) for d, t in texts.items() for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', t)}
    found = {(r.doc_id, r.finding) for r in rows if r.is_secret}
    assert tokens and found == tokens


def test_candidates_match_brute_force(documents):
    import re

    want = set()
    for r in documents.collect():
        for k, word in enumerate(re.split("[\x20\x09-\x0d]+", r.text)):
            runs = re.findall(r"[A-Za-z0-9+/=_.\-]{16,}", word)
            want |= {(r.doc_id, k, j, run) for j, run in enumerate(runs) if re.search("[0-9]", run)}
    got = {(r.doc_id, r.word, r.run, r.finding) for r in find_candidates(documents).collect()}
    assert got == want


@pytest.mark.parametrize("label, probability", [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_one_kind_of_labels(spark, label, probability):
    docs = spark.createDataFrame([(1, "x abcdefgh12345678zz y", None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([] if label is None else [("abcdefgh12345678zz", label)], "finding string, label int")
    assert [r.probability for r in scan_secrets(docs, labels).collect()] == [probability]


def test_odd_rows(spark, odd, none):
    extra = spark.createDataFrame([(20, 'token = "' + "ab12" * 10 + '"', None, None, None, 1, 1, True, 1)] * 2 + [(21, "1" * 20, None, None, None, 1, 1, True, 1)], odd.schema)
    rows = scan_secrets(odd.unionByName(extra)).collect()
    assert sorted((r.doc_id, r.is_secret) for r in rows) == [(20, True), (20, True), (21, False)]
    assert scan_secrets(none).count() == 0
    assert frequent_words(odd.where(F.col("doc_id") == 1)).count() == 7


def test_short_letter_only_punctuated_unquoted_and_url_secrets(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, want = [], set()
    for i in range(200):
        short = "".join(rng.choice(letters + "0123456789") for _ in range(8))
        plain = "".join(rng.choice(letters) for _ in range(20))
        odd = "p!" + short[:4] + "$@#" + short[4:] + "_x"
        kinds = [
            (f'password = "{short}"', short), (f"API_KEY={plain}", plain), (f'secret: "{odd}"', odd), (f"DB_PASSWORD={short}", short),
            (f"postgres://user:{odd}@db.example.com/x", odd), (f"https://example.com/page{i}0123456789/{plain}", None),
        ]
        text, value = kinds[i % 6]
        rows.append((i, f"the quick dog {text} sleeps near water", "src"))
        want |= {(i, value)} if value else set()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    told = {(r.doc_id, r.finding): r.is_secret for r in scan_secrets(docs).collect()}
    assert want <= set(told)
    assert sum(told[k] for k in want) >= 0.95 * len(want)
    assert not any(told[k] for k in told if k[0] % 6 == 5)
