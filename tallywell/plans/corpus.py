"""Corpus counts and word pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import text
from tallywell.operators import counts, indexing, pairs, translations
from tallywell.plans.standins import doc_lines, sql_lines
from tallywell.session import table

# DuckDB's own white space class for the whitespace tokeniser.
_SQL_WORDS = "unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+'))"
_SQL_TOKENS = "unnest(string_split(lower(line), ' '))"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_lines(spark, sf_dir).select(text.lower_tokens(F.col("line")).alias("tokens"))


def lower_tokens(spark, sf_dir):
    lines = doc_lines(spark, sf_dir).select("doc_id", "pos", text.lower_tokens(F.col("line")).alias("tokens"))
    return lines.select("doc_id", "pos", F.posexplode("tokens").alias("token_pos", "token"))


def word_count(spark, sf_dir):
    return counts.word_count(_tokens(spark, sf_dir))


def top_words(spark, sf_dir):
    return counts.top_k(counts.word_count(_tokens(spark, sf_dir)), 10)


def mr_word_count(spark, sf_dir):
    return counts.whitespace_word_count(table(spark, sf_dir, "documents"), "text")


def first_letter_count(spark, sf_dir):
    return counts.first_letter_count(table(spark, sf_dir, "documents"), "text")


def strip_lines(spark, sf_dir):
    padded = doc_lines(spark, sf_dir).withColumn("line", F.concat(F.lit(" \t\u00a0\x1c"), "line", F.lit("\x1f\n \u2003")))
    return padded.select("doc_id", "pos", text.strip(F.col("line")).alias("line"))


def row_count(spark, sf_dir):
    return counts.row_counts({
        "de": doc_lines(spark, sf_dir, "de"), "fr": doc_lines(spark, sf_dir, "fr"),
        "documents": table(spark, sf_dir, "documents"), "lineitem": table(spark, sf_dir, "lineitem"),
    })


def count_match(spark, sf_dir):
    return counts.count_match(doc_lines(spark, sf_dir, "de"), doc_lines(spark, sf_dir, "fr"))


def line_index(spark, sf_dir):
    return indexing.index_rows(doc_lines(spark, sf_dir), ["doc_id", "pos"]).select("doc_id", "pos", "idx")


def _aligned(spark, sf_dir):
    return pairs.aligned_lines(doc_lines(spark, sf_dir, "de"), doc_lines(spark, sf_dir, "fr"), ["doc_id", "pos"])


def aligned_lines(spark, sf_dir):
    return _aligned(spark, sf_dir)


def pair_filter(spark, sf_dir):
    kept = pairs.pair_filter(_aligned(spark, sf_dir))
    return kept.select("idx", F.size("left_words").alias("n_words"), F.concat_ws(" ", "left_words").alias("left_line"))


def aligned_word_pairs(spark, sf_dir):
    return pairs.word_pairs(pairs.pair_filter(_aligned(spark, sf_dir)))


def word_pair_count(spark, sf_dir):
    return pairs.word_pair_count(pairs.word_pairs(pairs.pair_filter(_aligned(spark, sf_dir))))


def word_translations(spark, sf_dir):
    found = translations.word_translations(translations.short_pairs(_aligned(spark, sf_dir), 12), rounds=3)
    return found.withColumn("probability", F.round("probability", 6))


def id_difference(spark, sf_dir):
    from tallywell.operators.tabular import id_difference as difference

    # Long ids with leading zeros on one side: 24 digits, equal numbers in different spellings.
    long_id = F.concat(F.lit("900000000000000000"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("\u00a0\x1d000"), long_id, F.lit(" \x1e")).alias("value"))
    item_id = F.concat(F.lit("+900000000000000000"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0"))
    items = table(spark, sf_dir, "lineitem").select(item_id.alias("value"))
    junk = table(spark, sf_dir, "events").select(F.col("event_type").alias("value"))
    return difference(orders.unionByName(junk), items.unionByName(junk))


QUERIES = {
    f.__name__: f
    for f in (
        lower_tokens, word_count, top_words, mr_word_count, first_letter_count, strip_lines, row_count, count_match,
        line_index, aligned_lines, pair_filter, aligned_word_pairs, word_pair_count, word_translations, id_difference,
    )
}

def _em_round(number: int) -> str:
    before = "1.0::DOUBLE" if number == 1 else "t"
    links = "links" if number == 1 else f"links JOIN p{number - 1} USING (left_word, right_word)"
    return f"""
s{number} AS (SELECT left_word, right_word, a * {before} / sum(a * {before}) OVER (PARTITION BY idx, right_word) * b AS share FROM {links}),
n{number} AS (SELECT left_word, right_word, sum(share) AS n FROM s{number} GROUP BY ALL),
p{number} AS (SELECT left_word, right_word, n / sum(n) OVER (PARTITION BY left_word) AS t FROM n{number})"""


_TRANSLATIONS = f"""WITH {sql_lines('de', 'de')}, {sql_lines('fr', 'fr')},
a AS (SELECT line AS left_line, row_number() OVER (ORDER BY doc_id, pos) AS idx FROM de),
b AS (SELECT line AS right_line, row_number() OVER (ORDER BY doc_id, pos) AS idx FROM fr),
pairs AS (
  SELECT idx, list_filter(string_split(lower(left_line), ' '), lambda w: w <> '') AS l,
         list_filter(string_split(lower(right_line), ' '), lambda w: w <> '') AS r FROM a JOIN b USING (idx)),
short AS (SELECT idx, [''] || l AS l, r FROM pairs WHERE len(l) BETWEEN 1 AND 12 AND len(r) BETWEEN 1 AND 12),
ls AS (SELECT idx, left_word, count(*) AS a FROM (SELECT idx, unnest(l) AS left_word FROM short) GROUP BY ALL),
rs AS (SELECT idx, right_word, count(*) AS b FROM (SELECT idx, unnest(r) AS right_word FROM short) GROUP BY ALL),
links AS (SELECT * FROM ls JOIN rs USING (idx)),{_em_round(1)},{_em_round(2)},{_em_round(3)}
SELECT left_word, right_word, round(t, 6) AS probability FROM p3"""

_ALIGNED = f"""WITH {sql_lines('de', 'de')}, {sql_lines('fr', 'fr')},
a AS (SELECT line AS left_line, row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx FROM de),
b AS (SELECT line AS right_line, row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx FROM fr),
aligned AS (SELECT idx, left_line, right_line FROM a JOIN b USING (idx)),
pairs AS (
  SELECT idx, string_split(lower(left_line), ' ') AS l, string_split(lower(right_line), ' ') AS r FROM aligned),
kept AS (SELECT * FROM pairs WHERE len(l) BETWEEN 1 AND 20 AND len(l) = len(r)),
words AS (
  SELECT idx, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS left_word, unnest(r) AS right_word FROM kept)
"""
_WORDS = f"SELECT word, count(*) AS n FROM (SELECT {_SQL_TOKENS} AS word FROM lines) WHERE word <> '' GROUP BY word"

ORACLE = {
    "word_translations": _TRANSLATIONS,
    "lower_tokens": f"""WITH {sql_lines('lines')}
      SELECT doc_id, pos, (generate_subscripts(string_split(lower(line), ' '), 1) - 1)::INTEGER AS token_pos,
             {_SQL_TOKENS} AS token FROM lines""",
    "word_count": f"WITH {sql_lines('lines')} {_WORDS}",
    "top_words": f"WITH {sql_lines('lines')} {_WORDS} ORDER BY n DESC, word LIMIT 10",
    "mr_word_count": f"SELECT word, count(*) AS n FROM (SELECT {_SQL_WORDS} AS word FROM documents) GROUP BY word",
    "first_letter_count": f"""SELECT lower(substr(word, 1, 1)) AS letter, count(*) AS n
      FROM (SELECT {_SQL_WORDS} AS word FROM documents) GROUP BY 1""",
    "strip_lines": f"WITH {sql_lines('lines')} SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(160) || chr(8195) || chr(28) || chr(31)) AS line FROM lines",
    "row_count": f"""WITH {sql_lines('de', 'de')}, {sql_lines('fr', 'fr')}
      SELECT 'de' AS table_name, count(*) AS n FROM de UNION ALL SELECT 'fr', count(*) FROM fr
      UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "count_match": f"""WITH {sql_lines('de', 'de')}, {sql_lines('fr', 'fr')}
      SELECT (SELECT count(*) FROM de) AS left_count, (SELECT count(*) FROM fr) AS right_count,
             (SELECT count(*) FROM de) = (SELECT count(*) FROM fr) AS same""",
    "line_index": f"""WITH {sql_lines('lines')}
      SELECT doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx FROM lines""",
    "aligned_lines": f"{_ALIGNED} SELECT * FROM aligned",
    "pair_filter": f"{_ALIGNED} SELECT idx, len(l)::INTEGER AS n_words, array_to_string(l, ' ') AS left_line FROM kept",
    "aligned_word_pairs": f"{_ALIGNED} SELECT * FROM words",
    "word_pair_count": f"{_ALIGNED} SELECT left_word, right_word, count(*) AS n FROM words GROUP BY ALL",
    "id_difference": """SELECT DISTINCT '900000000000000000' || lpad(o_orderkey::VARCHAR, 8, '0') AS id FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
}
