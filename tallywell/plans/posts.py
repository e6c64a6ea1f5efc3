"""Post documents and term shares."""

from __future__ import annotations

import os
import sys

from pyspark.sql import functions as F

from tallywell.functions import terms as tm
from tallywell.operators import counts, programs, term_trie, terms
from tallywell.operators.terms import term_list
from tallywell.plans.standins import REPOST, post_lines
from tallywell.session import table
from tallywell.sources import lines as line_sources
from tallywell.sources import posts, sinks
from tallywell.storage import fresh_path

# The default word list plus words that occur in the driver's documents.
TERMS = ("the", "la", "der", "de", *tm.PRONOUNS)


def _store_lines(frame, label):
    path = fresh_path(frame.sparkSession, label)
    frame.write.text(path)
    return path


def scan_ndjson(spark, sf_dir):
    scanned = posts.scan_ndjson(spark, _store_lines(post_lines(spark, sf_dir), "posts"))
    return scanned.select("text", F.col("retweeted_status.id").alias("repost_id"))


def scan_json_lines_raw(spark, sf_dir):
    spaced = post_lines(spark, sf_dir).select(F.concat("value", F.lit("\n  ")).alias("value"))
    lines = line_sources.scan_lines(spark, _store_lines(spaced, "raw-posts"))
    return posts.json_lines(lines).select("text", F.array_contains("keys", posts.RESHARE_KEY).alias("is_repost"))


def originals_by_key(spark, sf_dir):
    kept = posts.originals_by_key(posts.json_lines(post_lines(spark, sf_dir, explicit_nulls=True)))
    return kept.select("text")


def originals_by_null(spark, sf_dir):
    path = _store_lines(post_lines(spark, sf_dir, explicit_nulls=True), "posts")
    return posts.originals_by_null(posts.scan_ndjson(spark, path))


def sink_posts_table(spark, sf_dir):
    return posts.load_posts(spark, _store_lines(post_lines(spark, sf_dir), "posts"))


def _originals(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("source") != "src0").select("text")


def _rounded(shares):
    return shares.withColumn("pct", F.round("pct", 6))


def pronoun_share_extract(spark, sf_dir):
    return _rounded(terms.term_share_extract(_originals(spark, sf_dir), TERMS))


def pronoun_share_flags(spark, sf_dir):
    return _rounded(terms.term_share_flags(_originals(spark, sf_dir), TERMS))


def pronoun_share_filter(spark, sf_dir):
    return _rounded(terms.term_share_filter(_originals(spark, sf_dir), TERMS))


def regex_filter_count(spark, sf_dir):
    return terms.term_matches(table(spark, sf_dir, "conversations"), TERMS)


def zero_filled_counts(spark, sf_dir):
    found = table(spark, sf_dir, "conversations").select(
        F.explode(tm.distinct_terms(F.col("text"), TERMS)).alias("term")
    )
    grouped = found.groupBy("term").agg(F.count("*").alias("n"))
    return counts.zero_filled(grouped, term_list(found, TERMS), "term", "n")


def sum_by_key(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("key"), F.floor("value").cast("bigint").alias("count")
    )
    return counts.sum_by_key(pairs)


def mr_term_job(spark, sf_dir):
    posts_read = _originals(spark, sf_dir)
    # The mapper's emissions as an array per post: the post itself, then each term that it has.
    keys = F.concat(F.array(F.lit("posts")), tm.distinct_terms(F.col("text"), TERMS))
    emitted = posts_read.select(F.explode(keys).alias("key")).withColumn("count", F.lit(1).cast("bigint"))
    return counts.sum_by_key(emitted)


def mr_pipeline(spark, sf_dir):
    """A mapper, a combiner and a reducer program over posts as JSON lines."""
    folder = os.path.join(os.path.dirname(os.path.abspath(__file__)), "programs")
    add_up = [sys.executable, "sum_reducer.py"]
    written = programs.map_reduce(
        post_lines(spark, sf_dir), [sys.executable, "term_mapper.py", *TERMS], add_up, add_up,
        [os.path.join(folder, name) for name in ("term_mapper.py", "sum_reducer.py")],
    )
    return line_sources.scan_key_counts(written)


def term_share_trie(spark, sf_dir):
    # All words of the benchmark items, and the first two of each as a phrase.
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))
    listed = F.array_append(words, F.concat(F.get(words, F.lit(0)), F.lit("\n "), F.get(words, F.lit(1))))
    asked = table(spark, sf_dir, "benchmark").select(F.explode(listed).alias("term"))
    shares = _rounded(term_trie.term_share_trie(_originals(spark, sf_dir), asked))
    return shares.withColumn("term", F.regexp_replace("term", r"\s+", " "))


def scan_tsv_kv(spark, sf_dir):
    odd = F.col("event_id") % 7 == 0
    count = F.when(odd, "n/a").otherwise(F.floor("value").cast("bigint").cast("string"))
    extra = F.when(F.col("event_id") % 3 == 0, "\textra").otherwise("")
    lines = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("\t"), count, extra).alias("value"))
    return line_sources.scan_key_counts(line_sources.scan_lines(spark, _store_lines(lines, "key-counts")))


def _event_shares(spark, sf_dir):
    from tallywell.operators.tabular import group_share

    shares = group_share(table(spark, sf_dir, "events"), "event_type")
    return shares.select(F.col("event_type").alias("key"), F.col("n").alias("count"), (F.col("share") * 100).alias("pct"))


def sink_text_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    sinks.write_report(_event_shares(spark, sf_dir), path)
    return line_sources.scan_lines(spark, path).select(F.col("value").alias("line"))


def parse_report_lines(spark, sf_dir):
    line = F.format_string("%s %d (%.6f%% of total)", "key", "count", "pct")
    return line_sources.parse_share_lines(_event_shares(spark, sf_dir).select(line.alias("value")))


QUERIES = {
    f.__name__: f
    for f in (
        scan_ndjson, scan_json_lines_raw, originals_by_key, originals_by_null, sink_posts_table,
        pronoun_share_extract, pronoun_share_flags, pronoun_share_filter, regex_filter_count, zero_filled_counts,
        sum_by_key, mr_term_job, mr_pipeline, term_share_trie, scan_tsv_kv, sink_text_report, parse_report_lines,
    )
}

def _sql_matches(source: str) -> str:
    # One constant pattern per term; the consuming form stands in for look-around.
    hits = " UNION ALL ".join(
        f"""SELECT '{term}' AS term, count(*) FILTER (
              WHERE regexp_matches(lower(text), '(?:^|[^\\p{{L}}\\p{{M}}]){term}(?:$|[^\\p{{L}}\\p{{M}}])')) AS n FROM posts"""
        for term in TERMS
    )
    return f"posts AS ({source}), hits AS ({hits})"


_ORIGINALS = "SELECT text FROM documents WHERE source <> 'src0'"
_SHARE = f"""WITH {_sql_matches(_ORIGINALS)}
  SELECT term, n, (SELECT count(*) FROM posts) AS total,
         round(n::DOUBLE * 100 / (SELECT count(*) FROM posts), 6) AS pct FROM hits"""
_MATCHES = f"WITH {_sql_matches('SELECT text FROM conversations')} SELECT term, n FROM hits"

ORACLE = {
    "scan_ndjson": f"SELECT text, {REPOST} AS repost_id FROM documents",
    "scan_json_lines_raw": "SELECT text, source = 'src0' AS is_repost FROM documents",
    "originals_by_key": "SELECT text FROM documents WHERE source <> 'src0' AND doc_id % 2 = 1",
    "originals_by_null": _ORIGINALS,
    "sink_posts_table": _ORIGINALS,
    "pronoun_share_extract": _SHARE,
    "pronoun_share_flags": _SHARE,
    "pronoun_share_filter": _SHARE,
    "regex_filter_count": _MATCHES,
    "zero_filled_counts": _MATCHES,
    "sum_by_key": "SELECT event_type AS key, sum(floor(value)::BIGINT)::BIGINT AS count FROM events GROUP BY 1",
    "mr_term_job": f"""WITH {_sql_matches(_ORIGINALS)}
      SELECT term AS key, n AS count FROM hits WHERE n > 0 UNION ALL SELECT 'posts', count(*) FROM posts""",
    "mr_pipeline": f"""WITH {_sql_matches(_ORIGINALS)}
      SELECT term AS key, n AS count FROM hits WHERE n > 0 UNION ALL SELECT 'posts', count(*) FROM posts""",
    "term_share_trie": f"""WITH posts AS (
        SELECT row_number() OVER () AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}\\s]+') AS t FROM ({_ORIGINALS})),
      held AS (
        SELECT DISTINCT id, unnest(t) AS term FROM posts
        UNION SELECT DISTINCT id, unnest(list_transform(list_zip(t[:-2], t[2:]), lambda z: z[1] || ' ' || z[2])) FROM posts WHERE len(t) > 1),
      counted AS (SELECT term, count(*) AS n FROM held GROUP BY term),
      items AS (SELECT regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}]+') AS w FROM benchmark),
      asked AS (SELECT unnest(w) AS term FROM items UNION SELECT w[1] || ' ' || w[2] FROM items WHERE len(w) > 1)
      SELECT term, coalesce(n, 0) AS n, (SELECT count(*) FROM posts) AS total,
             round(coalesce(n, 0)::DOUBLE * 100 / (SELECT count(*) FROM posts), 6) AS pct
      FROM asked LEFT JOIN counted USING (term)""",
    "scan_tsv_kv": "SELECT event_type AS key, floor(value)::BIGINT AS count FROM events WHERE event_id % 7 <> 0",
    "sink_text_report": """SELECT printf('%s' || chr(9) || '%d' || chr(9) || '(%6.2f%% of total)', event_type, count(*),
        count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events)) AS line FROM events GROUP BY event_type""",
    "parse_report_lines": """SELECT event_type AS word, count(*) AS count,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 6) AS pct FROM events GROUP BY event_type""",
}
