from pyspark.sql import functions as F

from tallywell.functions import codes, terms, text
from tallywell.operators import counts, indexing, pairs, tabular
from tallywell.operators import terms as share
from tallywell.sources import lines as line_sources
from tallywell.sources import posts


def values(df, column=None):
    return [r[column or 0] for r in df.collect()]


def lines(spark, *items):
    return spark.createDataFrame([(i,) for i in items], "value string")


def test_tokens_keep_empties(spark):
    df = lines(spark, "", "A  b").select(text.lower_tokens(F.col("value")).alias("tokens"))
    assert values(df) == [[""], ["a", "", "b"]]
    assert {r["word"]: r["n"] for r in counts.word_count(df).collect()} == {"a": 1, "b": 1}


def test_whitespace_words_and_first_letters(spark):
    df = lines(spark, "", "Éa\tb\fB", "𝒜x é ")
    assert {r["word"]: r["n"] for r in counts.whitespace_word_count(df).collect()} == {
        "Éa": 1, "b": 1, "B": 1, "𝒜x": 1, "é": 1,
    }
    letters = {r["letter"]: r["n"] for r in counts.first_letter_count(df).collect()}
    assert letters == {"é": 2, "b": 2, "𝒜": 1}


def test_first_letters_add_up_to_words(spark):
    df = lines(spark, *[f"w{i % 7} x{i % 3} {'y ' * i}" for i in range(50)])
    letters = counts.first_letter_count(df).agg(F.sum("n")).first()[0]
    assert letters == counts.whitespace_word_count(df).agg(F.sum("n")).first()[0]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 9)], "word string, n long")
    assert values(counts.top_k(df, 3)) == ["d", "a", "b"]


TERMS = ("han", "hon", "den", "denna")
POSTS = [
    ("Han han HAN", {"han"}),
    ("denna", {"denna"}),
    ("handen", set()),
    ("han2 _hon han's", {"han", "hon"}),
    ("hań", set()),
    ("DEN,den", {"den"}),
    ("xden denx", set()),
    ("", set()),
]


def test_term_boundaries_agree_in_all_variants(spark):
    df = spark.createDataFrame([(p,) for p, _ in POSTS], "text string")
    found = values(df.select(terms.distinct_terms(F.col("text"), TERMS)))
    assert [set(f) for f in found] == [want for _, want in POSTS]
    want = {t: sum(t in w for _, w in POSTS) for t in TERMS}
    for variant in (share.term_share_extract, share.term_share_flags, share.term_share_filter):
        rows = variant(df, TERMS).collect()
        assert {r["term"]: r["n"] for r in rows} == want
        assert {r["total"] for r in rows} == {len(POSTS)}
        assert all(abs(r["pct"] - 100 * r["n"] / len(POSTS)) < 1e-9 for r in rows)


def test_no_posts_give_null_percent(spark):
    df = spark.createDataFrame([], "text string")
    for variant in (share.term_share_extract, share.term_share_flags, share.term_share_filter):
        assert [(r["n"], r["total"], r["pct"]) for r in variant(df, ["han"]).collect()] == [(0, 0, None)]


RAW = ['{"text":"a"}', "  ", '{"text":"b","retweeted_status":null}', '{"text":"c","retweeted_status":{"id":5}}',
       '{"text":"d","retweeted_status":{"x":5}}']


def test_originals_by_key_and_by_null_differ(spark, tmp_path):
    raw = lines(spark, *RAW)
    assert values(posts.originals_by_key(posts.json_lines(raw)), "text") == ["a"]
    path = str(tmp_path / "posts")
    raw.where("trim(value) <> ''").write.text(path)
    kept = posts.originals_by_null(posts.scan_ndjson(spark, path))
    assert sorted(values(kept, "text")) == ["a", "b"]
    assert kept.columns == ["text"]


def test_malformed_line_fails_or_is_dropped(spark):
    import pytest

    raw = lines(spark, '{"text":"a"}', "{broken")
    with pytest.raises(Exception, match="malformed JSON line"):
        posts.json_lines(raw).select("text").collect()
    assert values(posts.json_lines(raw, strict=False), "text") == ["a"]


def test_key_counts_drop_bad_numbers_and_extra_fields(spark):
    raw = lines(spark, "a\t1", "a\t2\tx", "b\tmany", "c\t 7 ", "lonely")
    parsed = line_sources.scan_key_counts(raw)
    assert sorted((r["key"], r["count"]) for r in parsed.collect()) == [("a", 1), ("a", 2), ("c", 7)]


def test_map_count_lines_sums_over_batches(spark):
    df = lines(spark, *["a b", "a"] * 100).repartition(7)
    counted = counts.map_count_lines(df, lambda line: ((w, 1) for w in line.split()))
    assert {r["key"]: r["count"] for r in counted.collect()} == {"a": 200, "b": 100}


def test_zero_filled_leaves_out_unlisted(spark):
    have = spark.createDataFrame([("a", 3), ("z", 1)], "term string, n long")
    keys = spark.createDataFrame([("a",), ("b",)], "term string")
    assert sorted(map(tuple, counts.zero_filled(have, keys, "term", "n").collect())) == [("a", 3), ("b", 0)]


def corpus(spark, items, parts):
    return spark.createDataFrame(list(enumerate(items)), "n long, line string").repartition(parts)


def test_index_is_dense_in_order(spark):
    for parts in (1, 5):
        df = corpus(spark, [f"l{i}" for i in range(500)], parts)
        assert all(r["n"] == r["idx"] for r in indexing.index_rows(df, ["n"]).collect())


def test_index_within_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 5}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n long").repartition(6)
    got = indexing.index_rows(df, ["n"], "rank", within=["k"]).collect()
    per_key = {}
    for key, n in sorted(rows, key=lambda r: r[1]):
        per_key.setdefault(key, []).append(n)
    assert {(r["k"], r["n"]): r["rank"] for r in got} == {(k, n): i for k, ns in per_key.items() for i, n in enumerate(ns)}


def test_index_file_lines_counts_on_over_files(spark, tmp_path):
    for name, items in (("b.txt", ["b0", "b1"]), ("a.txt", ["a0", "", "a2"]), ("c.txt", ["c0"])):
        (tmp_path / name).write_text("\n".join(items) + "\n")
    scanned = line_sources.scan_lines_with_position(spark, str(tmp_path))
    got = indexing.index_file_lines(scanned).orderBy("idx").collect()
    assert [(r["idx"], r["value"]) for r in got] == list(enumerate(["a0", "", "a2", "b0", "b1", "c0"]))


def test_aligned_pairs_edges(spark):
    left = ["", "Ein Haus", "a  b", " ".join("x" * 20), " ".join("x" * 21), "zu kurz", "surplus"]
    right = ["", "a house", "c  d", " ".join("y" * 20), " ".join("y" * 21), "three words here"]
    results = []
    for parts in (1, 4):
        aligned = pairs.aligned_lines(corpus(spark, left, parts), corpus(spark, right, parts), ["n"])
        assert aligned.count() == 6
        kept = pairs.pair_filter(aligned)
        assert sorted(r["idx"] for r in kept.collect()) == [0, 1, 2, 3]
        counted = pairs.word_pair_count(pairs.word_pairs(kept))
        results.append({(r["left_word"], r["right_word"]): r["n"] for r in counted.collect()})
    assert results[0] == results[1]
    assert results[0] == {("", ""): 2, ("ein", "a"): 1, ("haus", "house"): 1, ("a", "c"): 1, ("b", "d"): 1, ("x", "y"): 20}
    assert sorted(r["idx"] for r in pairs.pair_filter(aligned, drop_empty=True).collect()) == [1, 2, 3]


def test_id_difference(spark):
    long_id = "123456789012345678901234"
    left = lines(spark, "1", "2 ", "2", "x", "\t3", f"\u00a0000{long_id}", "+7", "-0", "1_000", "1__0", "_1", f"9{long_id}")
    right = lines(spark, "2", "y", f"9{long_id}", "007")
    assert sorted(values(tabular.id_difference(left, right))) == ["0", "1", "1000", long_id, "3"]


def test_codes_are_case_sensitive_and_null_safe(spark):
    df = spark.createDataFrame([("BK",), ("bk",), ("??",), (None,)], "c string")
    assert values(df.select(codes.expand_codes(F.col("c")))) == ["Black", "bk", "??", None]


def test_report_lines_round_trip(spark, tmp_path):
    import pytest

    from tallywell.sources import sinks

    df = spark.createDataFrame([("hen", 5, 12.5), ("den", 120, 100.0)], "key string, count long, pct double")
    path = str(tmp_path / "report")
    sinks.write_report(df, path)
    assert sorted(values(spark.read.text(path))) == ["den\t120\t(100.00% of total)", "hen\t5\t( 12.50% of total)"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_report(df, path)
    shares = line_sources.parse_share_lines(lines(spark, "den 1220703 (52.131662% of total)", "", "junk"))
    assert list(map(tuple, shares.collect())) == [("den", 1220703, 52.131662)]


def test_sums_before_each_row_and_spread_ties(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("v")).repartition(6)
    got = sorted((r["id"], r["s"]) for r in indexing.sum_before(df, ["id"], "v", "s").collect())
    total, want = 0, []
    for i in range(500):
        want.append((i, total))
        total += i % 7
    assert got == want
    ties = spark.range(3000).select("id", F.lit(1).alias("k"))
    ranked = indexing.index_rows(ties, ["k"], "i")
    assert sorted(r["i"] for r in ranked.collect()) == list(range(3000))
