"""Programs beside tasks, term tries, word translations and approximate nearest references."""

import itertools
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallywell.operators import programs, translations
from tallywell.operators.nearest import nearest_references
from tallywell.operators.nearest_lsh import nearest_references_lsh
from tallywell.operators.term_trie import TermTrie, term_share_trie, tokens_of

# --- programs --------------------------------------------------------------------------------------------------

MAPPER = "import sys\nfor line in sys.stdin:\n    for word in line.split():\n        print(f'{word}\\t1')\n"
ADD_UP = """import sys
key, total, lines = None, 0, 0
for line in sys.stdin:
    name, count = line.rstrip('\\n').split('\\t')
    if key is not None and name < key:
        sys.exit('not sorted')
    if name != key and key is not None:
        print(f'{key}\\t{total}')
        total = 0
    key, total = name, total + int(count)
if key is not None:
    print(f'{key}\\t{total}')
"""


@pytest.fixture(scope="module")
def scripts(tmp_path_factory):
    folder = tmp_path_factory.mktemp("programs")
    for name, body in (("count_mapper.py", MAPPER), ("add_up.py", ADD_UP)):
        (folder / name).write_text(body)
    return [str(folder / "count_mapper.py"), str(folder / "add_up.py")]


@pytest.mark.parametrize(("parts", "combine"), [(1, False), (7, False), (7, True)])
def test_map_reduce(spark, scripts, parts, combine):
    rng = random.Random(parts)
    lines = [" ".join(rng.choice(["hot", "hot", f"w{rng.randint(0, 300)}", "é"]) for _ in range(rng.randint(0, 9))) for _ in range(6000)]
    frame = spark.createDataFrame([(x,) for x in [*lines, None, ""]], "value string").repartition(parts)
    add_up = [sys.executable, "add_up.py"]
    got = programs.map_reduce(frame, [sys.executable, "count_mapper.py"], add_up, add_up if combine else None, scripts, reducers=parts)
    want = Counter(word for line in lines for word in line.split())
    assert sorted(r.value for r in got.collect()) == sorted(f"{word}\t{n}" for word, n in want.items())


def test_combiner_leaves_few_lines(spark, scripts):
    frame = spark.createDataFrame([("hot hot hot",)] * 5000, "value string").repartition(4)
    spark.sparkContext.addFile(scripts[0])
    spark.sparkContext.addFile(scripts[1])
    mapped = programs.pipe_lines(frame, [sys.executable, "count_mapper.py"])
    assert mapped.count() == 15_000
    assert programs.pipe_lines(mapped, [sys.executable, "add_up.py"]).count() == 4


def test_programs_that_fail(spark):
    frame = spark.createDataFrame([("x",)] * 100_000, "value string").repartition(2)
    with pytest.raises(Exception, match="ended with 3.*no such thing"):
        programs.pipe_lines(frame, [sys.executable, "-c", "import sys; sys.stderr.write('no such thing'); sys.exit(3)"]).count()
    with pytest.raises(Exception, match="ended with 1"):
        programs.pipe_lines(frame, [sys.executable, "-c", "input(); print('some'); raise ValueError"]).count()
    # A program may leave lines unread.
    assert programs.pipe_lines(frame, [sys.executable, "-c", "print(input())"]).count() == 2
    assert programs.pipe_lines(frame.limit(0), [sys.executable, "-c", "print(1)"]).count() == 0


# --- terms -----------------------------------------------------------------------------------------------------


def occurs(term, text):
    a, b = tokens_of(term), tokens_of(text)
    return bool(a) and any(b[i : i + len(a)] == a for i in range(len(b)))


def test_trie_finds_what_a_search_finds():
    rng = random.Random(4)
    for _ in range(300):
        terms = list({" ".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))})
        text = " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))
        found = TermTrie([tokens_of(t) for t in terms]).found(tokens_of(text))
        assert {terms[i] for i in found} == {t for t in terms if occurs(t, text)}


@pytest.mark.parametrize(("parts", "trie_bytes"), [(1, 1 << 20), (5, 1 << 20), (5, 60)])
def test_term_shares(spark, parts, trie_bytes):
    texts = ["Han han HAN", "den\n\tröda bilen", "han2 _hon, hen's", "handen denna", "den, röda", "", None, "covid-19 är här", "ét et"]
    terms = ["han", "den röda", "DEN RÖDA", "hon", "hen", "denna", "den", "covid-19", "röda bilen", "et", "-", "", "  ", None, "missing", "s"]
    posts = spark.createDataFrame([(t,) for t in texts * 3], "text string").repartition(parts)
    asked = spark.createDataFrame([(t,) for t in [*terms, "han"]], "term string")
    got = {r.term: (r.n, r.total, r.pct) for r in term_share_trie(posts, asked, trie_bytes=trie_bytes).collect()}
    want = {t: 3 * sum(occurs(t, x or "") for x in texts) for t in terms if t is not None}
    assert {t: n for t, (n, _, _) in got.items()} == want
    assert want["den röda"] == 3 and want["han"] == 6 and want["et"] == 3 and want["s"] == 3
    assert all(total == 27 and pct == pytest.approx(n * 100 / 27) for n, total, pct in got.values())
    nothing = term_share_trie(posts.limit(0), asked).collect()
    assert {(r.n, r.total, r.pct) for r in nothing} == {(0, 0, None)}
    assert term_share_trie(posts, asked.limit(0)).count() == 0


# --- translations ----------------------------------------------------------------------------------------------


def model_one(pairs, rounds):
    t = {}
    for number in range(rounds):
        n = defaultdict(float)
        for left, right in pairs:
            for f in right:
                own = [translations.NONE, *left]
                whole = sum(t[e, f] if number else 1.0 for e in own)
                for e in own:
                    n[e, f] += (t[e, f] if number else 1.0) / whole
        whole = defaultdict(float)
        for (e, _), x in n.items():
            whole[e] += x
        t = {(e, f): x / whole[e] for (e, f), x in n.items()}
    return t


@pytest.mark.parametrize(("parts", "rounds"), [(1, 1), (6, 4)])
def test_word_translations(spark, parts, rounds):
    words = {"das": "the", "haus": "house", "buch": "book", "ein": "a", "rot": "red"}
    rng = random.Random(1)
    lines = [tuple(rng.choice(list(words)) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    text = [(i, " ".join(x).title(), " ".join(words[w] for w in rng.sample(x, len(x))) + "  so" * (i % 9 == 0)) for i, x in enumerate(lines)]
    text += [(900, "", "nothing"), (901, "nichts", ""), (902, "lang " * 30, "long")]
    aligned = spark.createDataFrame(text, "idx long, left_line string, right_line string").repartition(parts)
    pairs = translations.short_pairs(aligned, 20)
    assert pairs.count() == 200
    found = translations.word_translations(pairs, rounds)
    got = {(r.left_word, r.right_word): r.probability for r in found.collect()}
    want = model_one([(a.lower().split(), b.split()) for i, a, b in text[:200]], rounds)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    if rounds > 1:
        best = {r.left_word: r.right_word for r in translations.best_translations(found).collect()}
        assert {w: best[w] for w in words} == words
    assert translations.word_translations(pairs.limit(0), 2).count() == 0


# --- nearest references ----------------------------------------------------------------------------------------


def vectors(rng, n, dim, spread):
    centres = rng.normal(size=(max(1, n // 40), dim))
    return centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize(("spread", "parts"), [(0.2, 1), (0.6, 5)])
def test_recall_of_nearest_references(spark, spread, parts):
    rng = np.random.default_rng(3)
    v = vectors(rng, 2000, 24, spread)
    v = np.concatenate([v, np.repeat(v[:1], 800, axis=0)])  # over a quarter of all references are copies of one
    refs = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "ref_id long, vector array<double>").repartition(parts)
    asked = refs.where("ref_id % 20 = 0").withColumnRenamed("ref_id", "query_id").unionByName(
        spark.createDataFrame([(-1, None), (-2, (v[7] + 0.01).tolist())], "query_id long, vector array<double>"))
    exact = {(r.query_id, r["rank"]): r.distance2 for r in nearest_references(asked.where("vector IS NOT NULL"), refs, k=3).collect()}
    rows = nearest_references_lsh(asked, refs, k=3, bucket_rows=64).collect()
    got = {(r.query_id, r["rank"]): r.distance2 for r in rows}
    assert not {q for q, _ in got} & {-1}
    for r in rows:
        query = v[r.query_id] if r.query_id >= 0 else v[7] + 0.01
        assert r.distance2 == pytest.approx(((query - v[r.ref_id]) ** 2).sum())
        assert r.distance2 >= exact[r.query_id, r["rank"]] * (1 - 1e-9)
    hits = [got.get(key, np.inf) <= least * (1 + 1e-9) for key, least in exact.items()]
    assert np.mean(hits) >= 0.9
    # The copies' least ids come first.
    assert [r.ref_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 0] == [0, 2000, 2001]


def test_vectors_that_no_sign_tells_apart(spark):
    """Different vectors in one direction from the centre: blocks of one bucket, and still every reference."""
    rows = [(i, [1.0 + i * 1e-9, 1.0]) for i in range(300)] + [(1000 + i, [-1.0, -1.0 - i * 1e-9]) for i in range(300)]
    refs = spark.createDataFrame(rows, "ref_id long, vector array<double>")
    asked = spark.createDataFrame([(1, [1.0 + 150e-9, 1.0])], "query_id long, vector array<double>")
    got = nearest_references_lsh(asked, refs, k=2, bucket_rows=16, tables=2, probes=1).collect()
    assert sorted((r["rank"], r.ref_id) for r in got)[0] == (1, 150)
    assert nearest_references_lsh(asked, refs.limit(0)).count() == 0
    assert nearest_references_lsh(asked.limit(0), refs).count() == 0
    few = {r.query_id: r.ref_id for r in nearest_references_lsh(asked, refs.limit(1), k=5).collect()}
    assert len(few) == 1


def test_pairs_of_words_are_not_lost():
    assert list(itertools.islice(tokens_of("a  b-c"), 9)) == ["a", "b", "-", "c"]
