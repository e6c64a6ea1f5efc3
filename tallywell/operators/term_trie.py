"""Share of texts that hold each term of a list of any size: one pass over the words, whatever the number of terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions.numbers import percent
from tallywell.storage import materialize

#: Bytes of terms that go to the tasks at once.
TRIE_BYTES = 32 << 20
# Words (letters and marks) and what stands between them; white space is only passed over.
_TOKEN = regex.compile(r"[\p{L}\p{M}]+|[^\p{L}\p{M}\s]+")


def tokens_of(text: str) -> list[str]:
    """Words and runs of other characters of a text in lower case, without white space."""
    return _TOKEN.findall(text.lower())


class TermTrie:
    """Trie of terms over whole tokens, with failure links: every term that occurs is found in one walk over a text.

    A state is a row of the lists; ``step[s]`` leads on by a token, ``fail[s]`` to the longest end of what was read that
    starts another term, ``ends[s]`` is the term that ends there (-1: none), ``shorter[s]`` the next such state by failure links.
    """

    def __init__(self, terms: Iterable[list[str]]):
        self.step: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for number, tokens in enumerate(terms):
            state = 0
            for token in tokens:
                if token not in self.step[state]:
                    self.step[state][token] = len(self.step)
                    self.step.append({})
                    self.ends.append(-1)
                state = self.step[state][token]
            if state:
                self.ends[state] = number
        self.fail, self.shorter = [0] * len(self.step), [0] * len(self.step)
        level = list(self.step[0].values())
        while level:  # shorter paths first: a failure link leads to one
            deeper = []
            for state in level:
                for token, child in self.step[state].items():
                    other = self.fail[state]
                    while other and token not in self.step[other]:
                        other = self.fail[other]
                    other = self.step[other].get(token, 0)
                    self.fail[child] = other
                    self.shorter[child] = other if self.ends[other] >= 0 else self.shorter[other]
                    deeper.append(child)
            level = deeper

    def found(self, tokens: list[str]) -> set[int]:
        """Numbers of the terms that occur in ``tokens``."""
        step, fail, ends, shorter = self.step, self.fail, self.ends, self.shorter
        state, out = 0, set()
        for token in tokens:
            while state and token not in step[state]:
                state = fail[state]
            state = step[state].get(token, 0)
            at = state
            while at:
                if ends[at] >= 0:
                    if ends[at] in out:
                        break  # so are the shorter ones
                    out.add(ends[at])
                at = shorter[at]
        return out


def _counted(posts: DataFrame, terms: list[str], text: str) -> DataFrame:
    """(term number, n), the number of posts as -1."""
    tokens = {term: tuple(tokens_of(term)) for term in terms}
    # Terms of the same tokens are one.
    paths = list(dict.fromkeys(own for own in tokens.values() if own))
    number = {own: i for i, own in enumerate(paths)}
    trie = TermTrie(paths)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts[-1] += 1
                if value:
                    counts.update(trie.found(tokens_of(value)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["number", "n"]
        )

    found = posts.select(F.col(text).cast("string")).mapInArrow(of, "number long, n long")
    # Stored, as the total is read apart from the terms.
    sums = materialize(found.groupBy("number").agg(F.sum("n").alias("n")), "term-counts")
    named = posts.sparkSession.createDataFrame([(t, number.get(own, -2)) for t, own in tokens.items()], "term string, number long")
    whole = F.coalesce(sums.where("number = -1").select("n").scalar(), F.lit(0))
    return named.join(sums, "number", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"), whole.alias("total"))


def term_share_trie(posts: DataFrame, terms: DataFrame, text: str = "text", term: str = "term", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(term, n, total, pct): in how many posts each term stands as whole words, of how many.

    A term is one word or a phrase; case and the white space between its words make no difference, and a word ends at
    anything but a letter or mark. Terms without any text count 0; equal terms come once, null ones not at all. Without posts
    ``pct`` is null. Terms go to the tasks ``trie_bytes`` at a time; each such block is one pass over the posts, in which
    a task sends one row per term it has found.
    """
    listed = materialize(terms.select(F.col(term).alias("term")).where("term IS NOT NULL").distinct(), "terms")
    size = listed.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, -(-size // trie_bytes))
    out = posts.sparkSession.createDataFrame([], "term string, n long, total long")
    for k in range(blocks):
        own = [r.term for r in listed.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == k).collect()]  # about trie_bytes
        if own:
            out = out.unionByName(materialize(_counted(posts, own, text), "term-shares"))
    return out.select("term", "n", "total", percent(F.col("n"), F.col("total")).alias("pct"))
