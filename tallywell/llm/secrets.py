"""Secret scan with a random forest that removes false positives. DataFrame functions and Spark ML only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.storage import materialize

LEAST_CHARS = 16
_RUN = rf"[A-Za-z0-9+/=_.\-]{{{LEAST_CHARS},}}"
#: Labelled findings of each kind that the forest is fitted on at most; they are taken in the order of a hash.
SAMPLE = 10_000
#: Most frequent words of the corpus that count as a dictionary.
DICTIONARY = 20_000
_HASHED = 16
_SECRET_NAME = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|bearer|auth)"
_OTHER_NAME = r"(?i)(sha1|sha256|md5|checksum|digest|commit|hash|isbn|order|invoice|tracking|card|phone|url|http)"

_QUOTES = "[\"'`]"
#: A value after a secret-like name in the same word, a name that the next word is assigned to, and a URL's password.
_ASSIGNED = rf"{_SECRET_NAME}\w*{_QUOTES}?\s*[=:]+>?\s*$"
_VALUE = rf"{_SECRET_NAME}\w*{_QUOTES}?[=:]+>?({_QUOTES}?[^=:/\s].*)$"
_URL_PASSWORD = r"://[^/:@\s]*:(\S+)@"
#: Stands for a value that is put in later.
_PLACEHOLDER = r"(?i)^([$<{%]|\*+$|x+$|\.+$)"


def find_candidates(docs: DataFrame) -> DataFrame:
    """Runs of 16 characters or more of ``[A-Za-z0-9+/=_.-]`` with a digit, in whole texts, with what stands around them.

    Columns: doc_id, path (the source), word (number of the word in the text), run (number in the word), finding, before
    (two words), after (one word), wrapped (the whole word). Null texts and ids are allowed; null texts have none. Other
    columns are ignored.
    """
    words = docs.select(
        "doc_id", F.col("source").alias("path"), F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+").alias("w")
    )
    long_ones = F.transform(
        "w", lambda x, i: F.when((F.length(x) >= LEAST_CHARS) & x.rlike("[0-9]") & x.rlike(_RUN), i)
    )
    placed = words.withColumn("at", F.filter(long_ones, lambda i: i.isNotNull())).where(F.size("at") > 0)

    def near(i: Column, step: int) -> Column:
        return F.coalesce(F.get("w", i + step), F.lit(""))

    around = F.transform(
        "at",
        lambda i: F.struct(
            i.alias("word"), F.get("w", i).alias("wrapped"), F.concat_ws(" ", near(i, -2), near(i, -1)).alias("before"),
            near(i, 1).alias("after"),
        ),
    )
    rows = placed.select("doc_id", "path", F.explode(around).alias("h")).select("doc_id", "path", "h.*")
    runs = rows.select("*", F.posexplode(F.regexp_extract_all("wrapped", F.lit(_RUN), F.lit(0))).alias("run", "finding"))
    return runs.where(F.col("finding").rlike("[0-9]"))


def _url_password() -> Column:
    return F.regexp_extract("wrapped", _URL_PASSWORD, 1)


def _named_value(wrapped: Column, before: Column) -> Column:
    """The value in a word that a secret-like name in it or before it is assigned, without its quotes; else empty."""
    own = F.regexp_extract(wrapped, _VALUE, 2)
    value = F.when(own != "", own).when(before.rlike(_ASSIGNED), wrapped).otherwise("")
    quoted = F.regexp_extract(value, rf"^({_QUOTES})(.+)\1", 2)
    return F.when(quoted != "", quoted).otherwise(F.regexp_replace(value, rf"^{_QUOTES}+|({_QUOTES}|[,;])+$", ""))


def find_named(docs: DataFrame) -> DataFrame:
    """Values after secret-like names and passwords in URLs, of any length and characters; columns of ``find_candidates``.

    ``run`` is -1. Values that are runs of ``find_candidates`` themselves are left out. A value ends at white space.
    """
    words = docs.select(
        "doc_id", F.col("source").alias("path"), F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+").alias("w")
    )

    def near(i: Column, step: int) -> Column:
        return F.when(i + step >= 0, F.coalesce(F.get("w", i + step), F.lit(""))).otherwise("")

    # The words that hold a name or a URL's password, and the two after a name.
    marks = F.transform("w", lambda x, i: F.when(x.rlike(_SECRET_NAME) | x.rlike(_URL_PASSWORD), i))
    marked = words.withColumn("at", F.filter(marks, lambda i: i.isNotNull())).where(F.size("at") > 0)
    places = F.array_distinct(F.flatten(F.transform("at", lambda i: F.array(i, i + 1, i + 2))))
    around = F.transform(
        F.filter(places, lambda i: i < F.size("w")),
        lambda i: F.struct(
            i.alias("word"), F.get("w", i).alias("wrapped"), F.concat_ws(" ", near(i, -2), near(i, -1)).alias("before"),
            near(i, 1).alias("after"),
        ),
    )
    rows = marked.select("doc_id", "path", F.explode(around).alias("h")).select("doc_id", "path", "h.*")
    both = F.array_distinct(F.array(_url_password(), _named_value(F.col("wrapped"), F.col("before"))))
    found = rows.select("*", F.lit(-1).alias("run"), F.explode(both).alias("finding")).where("finding <> ''")
    runs = F.regexp_extract_all("wrapped", F.lit(_RUN), F.lit(0))
    return found.where(~(F.array_contains(runs, F.col("finding")) & F.col("finding").rlike("[0-9]")))


def frequent_words(docs: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """The ``size`` lower-case words of three letters or more that most documents hold (ties by the word)."""
    own = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    words = docs.select(F.explode(F.filter(own, lambda x: F.length(x) >= 3)).alias("part"))
    return words.groupBy("part").count().orderBy(F.desc("count"), "part").limit(size).select("part")


def _share(pattern: str) -> Column:
    return F.regexp_count("finding", F.lit(pattern)) / F.length("finding")


def add_features(findings: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, list[str]]:
    """Findings (stored, with a unique ``fid``) with the features of the forest.

    Length; shares of character kinds; transitions between kinds and between vowels and consonants; part of the letters
    that dictionary words cover; words in the path; words around the finding (hashed, and two kinds of names).
    """
    parts = findings.select(
        "fid", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit(r"[a-z]{3,}"), F.lit(0))).alias("part")
    )
    covered = parts.join(dictionary, "part").groupBy("fid").agg(F.sum(F.length("part")).alias("_covered"))
    around = F.split(F.lower(F.concat_ws(" ", "before", "after")), " ")
    path = F.coalesce("path", F.lit(""))
    before = F.concat_ws(" ", "before", F.regexp_extract("wrapped", r"^[^\"']*", 0))
    plain = {
        "f_length": F.length("finding"),
        "f_digits": _share("[0-9]"), "f_upper": _share("[A-Z]"), "f_lower": _share("[a-z]"),
        "f_hex": _share("[0-9a-fA-F]"), "f_other": _share("[^A-Za-z0-9]"),
        "f_letter_digit": _share("[A-Za-z](?=[0-9])"), "f_digit_letter": _share("[0-9](?=[A-Za-z])"),
        "f_lower_upper": _share("[a-z](?=[A-Z])"), "f_upper_lower": _share("[A-Z](?=[a-z])"),
        "f_vowel_other": _share("(?i)[aeiou](?=[b-df-hj-np-tv-z])"), "f_repeat": _share(r"(.)(?=\1)"),
        "f_dictionary": F.coalesce(F.col("_covered"), F.lit(0)) / F.length("finding"),
        "f_path_test": path.rlike("(?i)(test|example|sample|mock|fixture|demo|doc)").cast("int"),
        "f_path_depth": F.regexp_count(path, F.lit("/")), "f_path_config": path.rlike("(?i)(env|conf|ya?ml|json|ini)").cast("int"),
        "f_secret_name": before.rlike(_SECRET_NAME).cast("int"), "f_other_name": before.rlike(_OTHER_NAME).cast("int"),
        "f_assigned": before.rlike(r"[=:]\s*$").cast("int"), "f_quoted": F.col("wrapped").rlike("[\"'`]").cast("int"),
        "f_url_password": (F.col("finding") == _url_password()).cast("int"),
        "f_named": (F.col("finding") == _named_value(F.col("wrapped"), F.col("before"))).cast("int"),
        "f_address": F.col("wrapped").rlike(r"(@|://|\.(com|org|net|html?)\b)").cast("int"),
    }
    numbers = F.transform(around, lambda x: F.pmod(F.xxhash64(x), F.lit(_HASHED)))
    for k in range(_HASHED):
        plain[f"f_word_{k}"] = F.array_contains(numbers, F.lit(k).cast("long")).cast("int")
    joined = findings.join(covered, "fid", "left")
    columns = [c.cast("double").alias(name) for name, c in plain.items()]
    return joined.select(*findings.columns, *columns), list(plain)


def rule_labels() -> Column:
    """Labels (1 secret, 0 not, null unknown) for findings that nobody has labelled, from signs that are hardly ever wrong.

    A value in quotes assigned to a name such as token or password is a secret, so is the value of name=value and the
    password of a URL, unless it is a placeholder; numbers, addresses and words of a text without such a name are not. All
    else is left to the forest.
    """
    before = F.concat_ws(" ", "before", F.regexp_extract("wrapped", r"^[^\"']*", 0))
    quoted = before.rlike(_SECRET_NAME + r"\w*[\"']?\s*[=:]\s*$") & F.col("wrapped").rlike("[\"']")
    password = F.col("finding") == _url_password()
    named = F.col("finding") == _named_value(F.col("wrapped"), F.col("before"))
    secret = (quoted & named) | password | (named & F.col("wrapped").rlike(_SECRET_NAME + r"\w*="))
    other = F.col("finding").rlike(r"^[0-9.\-+/=]+$") | F.col("wrapped").rlike(r"(@|://)")
    return F.when(secret & ~F.col("finding").rlike(_PLACEHOLDER), 1).when(other & ~named & ~password, 0)


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE, trees: int = 20, depth: int = 6, seed: int = 11
) -> DataFrame:
    """All candidates of ``docs`` with the forest's ``probability`` and ``is_secret`` (0.5 or more).

    ``labelled``: columns finding, label (1 secret, 0 not), joined by the finding; else ``rule_labels``. At most ``sample``
    findings of each label are fitted on; everything else covers all rows. With labels of one kind only, that kind's share
    is the probability of all; without any it is 0. Columns: doc_id, word, run (-1 for ``find_named``), finding, probability, is_secret. Rows that
    repeat give repeated findings.
    """
    found = find_candidates(docs).unionByName(find_named(docs))
    stored = materialize(found.withColumn("fid", F.monotonically_increasing_id()), "secret-findings")
    dictionary = materialize(frequent_words(docs), "secret-words")
    featured, names = add_features(stored, dictionary)
    if labelled is None:
        marked = featured.withColumn("label", rule_labels().cast("double"))
    else:
        known = labelled.groupBy("finding").agg(F.max("label").cast("double").alias("label"))
        marked = featured.join(known, "finding", "left")
    vectors = materialize(
        VectorAssembler(inputCols=names, outputCol="features").transform(marked)
        .select("fid", "doc_id", "word", "run", "finding", "label", "features"),
        "secret-features",
    )
    order = F.xxhash64("finding", "fid")
    chosen = None
    for label in (0.0, 1.0):
        own = vectors.where(F.col("label") == label).orderBy(order, "fid").limit(sample).select("label", "features")
        chosen = own if chosen is None else chosen.unionByName(own)
    training = materialize(chosen, "secret-training")
    kinds = {r["label"] for r in training.select("label").distinct().collect()}
    columns = ["doc_id", "word", "run", "finding"]
    if kinds == {0.0, 1.0}:
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=False)
        scored = forest.fit(training).transform(vectors)
        probability = F.get(vector_to_array("probability"), F.lit(1))
    else:
        scored, probability = vectors, F.lit(1.0 if 1.0 in kinds else 0.0)
    told = scored.select(*columns, probability.alias("probability"))
    return told.withColumn("is_secret", F.col("probability") >= 0.5)
