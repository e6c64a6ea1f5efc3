"""Quality rules under weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallywell.llm.words import WHITE, blocks, mix, windows, words_of
from tallywell.storage import materialize

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "n_words n_chars word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_cased n_ending n_distinct"
).split()


def _table(chosen: bytes) -> np.ndarray:
    flags = np.zeros(256, np.int64)
    flags[list(chosen)] = 1
    return flags


_SYMBOL, _SPACE = _table(SYMBOLS), _table(WHITE)
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_ENDING = _table(b"!?|")
_POINT = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64)


def _repeats(text: np.ndarray, words: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words that lie in a 5-word window found twice or more in it, and distinct words."""
    own = mix(text.astype(np.uint64) + np.uint64(1)) ^ words
    distinct = np.bincount(text[np.unique(own, return_index=True)[1]], minlength=n_texts)
    grams = windows(words, 5)
    inside = text[: len(grams)] == text[4:]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(n_texts, np.int64), distinct
    key = grams[at] ^ mix(text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + 5, -1)
    covered = np.cumsum(change)[:-1] > 0
    return np.bincount(text[covered], minlength=n_texts), distinct


def _features(texts: list[bytes]) -> dict[str, np.ndarray]:
    n = len(texts)
    sizes = np.fromiter((len(t) for t in texts), np.int64, n)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(sizes)])

    def total(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[raw])])[bounds])

    words = words_of(texts)
    points, white = total(_POINT), total(_SPACE)
    repeat, distinct = _repeats(words.text, words.hash, n)
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(texts):
        used = [line for line in text.split(b"\n") if line.strip(WHITE)]
        lines[i], dups[i] = len(used), len(used) - len(set(used))
    upper = total(_UPPER)
    return {
        "n_words": np.bincount(words.text, minlength=n), "n_chars": points, "word_chars": points - white,
        "n_symbols": total(_SYMBOL), "n_lines": lines, "n_dup_lines": dups, "n_repeat_words": repeat,
        "n_upper": upper, "n_cased": upper + total(_LOWER), "n_ending": total(_ENDING), "n_distinct": distinct,
    }


def add_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts in ``FEATURES`` to all columns of ``docs`` (columns of these names are replaced).

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text; null is the empty text. ``n_repeat_words``: words in
    5-word windows that the text holds twice or more, the first included. ``n_dup_lines``: lines with a word equal
    to an earlier line. Code points are counted, not bytes.
    """
    kept = [c for c in docs.columns if c not in FEATURES]
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col(text).cast("binary").alias("_raw"))
    carried = rows.drop("_raw")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema)
    schema = (schema + ", " if schema else "") + ", ".join(f"`f_{f}` long" for f in FEATURES)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            parts = [_features(texts[a:b]) for a, b in blocks([len(t) for t in texts])]
            own = [np.concatenate([p[f] for p in parts]) if parts else np.zeros(0, np.int64) for f in FEATURES]
            names = [*batch.schema.names[:-1], *[f"f_{f}" for f in FEATURES]]
            arrays = [*batch.columns[:-1], *[pa.array(x, pa.int64()) for x in own]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    found = rows.mapInArrow(of, schema)
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]
    return found.select(*names, *[F.col(f"f_{f}").alias(f) for f in FEATURES])


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) where ``good`` holds, else 0 (bad) where ``bad`` holds, else -1 (abstains)."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(F.coalesce(self.good, F.lit(False)), 1).when(F.coalesce(self.bad, F.lit(False)), 0).otherwise(-1)


def default_rules() -> list[Rule]:
    """Rules on the counts alone; a rule abstains on texts too small or unclear for it."""

    def share(name: str, of: str, good: int, bad: int, enough: int = 20) -> Rule:
        part, whole = 100 * F.col(name), F.col(of)
        return Rule(f"{name}/{of}", (whole >= enough) & (part <= good * whole), (whole >= enough) & (part >= bad * whole))

    mean = F.try_divide(F.col("word_chars"), F.col("n_words"))
    return [
        share("n_symbols", "n_words", 3, 10),
        share("n_symbols", "n_chars", 1, 4, 100),
        share("n_dup_lines", "n_lines", 10, 30, 5),
        share("n_repeat_words", "n_words", 5, 15),
        share("n_upper", "n_cased", 20, 50, 40),
        share("n_ending", "n_words", 5, 15),
        Rule("mean word", mean.between(3, 12), (mean < 2) | (mean > 18)),
        Rule("variety", (F.col("n_words") >= 20) & (F.col("n_distinct") >= 10 * F.sqrt("n_words") / 4),
             (F.col("n_words") >= 60) & (F.col("n_distinct") < F.sqrt("n_words"))),
        Rule("length", F.col("n_words") >= 10, F.col("n_words") < 5),
    ]


@dataclass
class VoteModel:
    """P(vote | class) of each rule (classes bad, good; votes bad, good) and P(good)."""

    prior: float
    tables: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.zeros((len(votes), 2)) + np.log([1 - self.prior, self.prior])
        for j in range(votes.shape[1]):
            voted = votes[:, j] >= 0
            logs[voted] += np.log(self.tables[j][:, votes[voted, j]]).T
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(1)


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> VoteModel:
    """Expectation-maximisation on distinct vote patterns and how many documents have each.

    A rule has a chance to vote good on good documents and one to vote bad on bad ones; most rules see one kind of bad
    document only, so the second may be small. A rule never counts against its own meaning: it votes good on good
    documents at least nine times in ten, and bad on bad ones at least twice as often as on good ones. The share
    of good documents stays between 0.5 and 0.99.
    """
    start = np.array([[0.4, 0.6], [0.05, 0.95]])
    model = VoteModel(0.85, np.tile(start, (votes.shape[1], 1, 1)))
    for _ in range(rounds if len(votes) else 0):
        good = model.posterior(votes) * counts
        bad = counts - good
        tables = np.empty_like(model.tables)
        for j in range(votes.shape[1]):
            voted, no = votes[:, j] >= 0, votes[:, j] == 0
            miss = (good[no].sum() + 0.5) / (good[voted].sum() + 10)
            hit = (bad[no].sum() + 4) / (bad[voted].sum() + 10)
            miss = min(max(miss, 0.001), 0.1)
            hit = min(max(hit, 2 * miss), 0.99)
            tables[j] = [[hit, 1 - hit], [miss, 1 - miss]]
        prior = min(max((good.sum() + 8.5) / (counts.sum() + 10), 0.5), 0.99)
        moved = max(abs(prior - model.prior), np.abs(tables - model.tables).max())
        model = VoteModel(prior, tables)
        if moved < 1e-9:
            break
    return model


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(featured: DataFrame, rules: list[Rule] | None = None, threshold: float = 0.5) -> DataFrame:
    """Add ``base_failed``, ``quality`` (posterior probability of good) and ``kept`` to a stored frame with FEATURES.

    Votes of all documents are counted by pattern; with r rules there are at most 3^r patterns, so the table that
    is fitted and joined back is bounded whatever the number of rows. A document is kept if it does not fail the base
    rules and its posterior is at least ``threshold``. No rows: the model is its starting point.
    """
    rules = rules or default_rules()
    if len(rules) > 10:
        raise ValueError("at most 10 rules: the table of vote patterns must stay small")
    code = sum((rule.vote() + 1) * 3**j for j, rule in enumerate(rules)).cast("int")
    voted = featured.withColumn("_votes", code)
    patterns = voted.groupBy("_votes").count().collect()
    codes = np.array([r["_votes"] for r in patterns], np.int64)
    votes = codes[:, None] // 3 ** np.arange(len(rules)) % 3 - 1
    model = fit_votes(votes, np.array([r["count"] for r in patterns], float))
    rows = [Row(_votes=int(c), quality=float(q)) for c, q in zip(codes, model.posterior(votes))]
    verdicts = featured.sparkSession.createDataFrame(rows, "_votes int, quality double")
    judged = voted.join(F.broadcast(verdicts), "_votes")  # at most 3^10 rows
    return judged.drop("_votes").withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, quality and kept. The text is read once, its counts are stored."""
    return judge(materialize(add_features(docs.select("doc_id", "text")).drop("text"), "quality-counts"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, same columns.

    Verdicts are reached per row, so repeated rows and ids, null ones too, don't matter. A null or empty text has no words and
    goes with the base rules; without documents there are no rows.
    """
    featured = materialize(add_features(docs), "quality-documents")
    return judge(featured).where("kept").select(*[F.col(c) for c in docs.columns])
