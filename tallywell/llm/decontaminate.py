"""Benchmark items in documents: CGK embedding, bit sampling over item-sized windows, exact edit verification.

A CGK walk reads a text one symbol per step and moves on or stays by a random bit that depends on the step and the
symbol. Two texts a few edits apart soon read the same symbols at the same steps again, so edit distance becomes Hamming
distance, and texts that agree at a few sampled steps are candidates. Symbols are words in lower case without ASCII
punctuation. The walk starts at every word of every document, which makes each item-sized window a candidate; items
are embedded once. A repetition has its own random bits, sampled steps and, so that an edit near an item's start does no
harm to all of them, its own offsets into the items. Steps are sampled within a short span, and long items have more
offsets, so that recall does not fall with the length of an item.

A match is a stretch of a document within ``EDITS`` edits per word of the item. Items under ``LEAST_WORDS`` words are
looked for exactly: as words in a row or, if they hold characters of a script without spaces, as a run of characters,
whatever white space is in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.words import Words, blocks, mix, normal_text, windows, words_of

EDITS = 0.2
#: Items of fewer words are looked for exactly only.
LEAST_WORDS = 5
#: Thai, Lao, Myanmar, Khmer; kana, Han and their punctuation.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Sampled steps per repetition, the steps among which they are at most, and the part of the items that each repetition skips.
SAMPLED = 5
SPAN = 16
OFFSETS = (0.0, 0.2, 0.4, 0.6, 0.1, 0.3, 0.5, 0.7)
#: Words between a repetition's offsets into an item, and the most of them: 64 tries in 8 repetitions miss next to nothing.
STRIDE, MOST_STARTS = 6, 8
#: Benchmark text that one pass over the documents searches for; more takes more passes.
ITEM_BYTES = 8 << 20
_PASS_WORDS = 1 << 16


class Plan:
    """One repetition: walk bits and, for each class of item sizes, sampled steps and the items' keys."""

    def __init__(self, number: int, items: list[np.ndarray]):
        rng = np.random.default_rng((29, number))
        share = OFFSETS[number % len(OFFSETS)]
        self.bits = rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        places = (np.arange(SAMPLED) + rng.random(SAMPLED)) / SAMPLED
        self.classes = []
        sizes = np.array([len(x) for x in items])
        low = LEAST_WORDS
        while low <= sizes.max(initial=0):
            high = max(low + 1, low * 3 // 2)
            if int((1 - max(OFFSETS)) * low) >= SPAN:  # larger items have the same steps
                high = sizes.max() + 1
            own = [i for i in np.flatnonzero((sizes >= low) & (sizes < high))]
            if own:
                # Walks move on at every other step, so these steps lie within the smallest item of the class.
                span = min(max(int((1 - share) * low), SAMPLED), SPAN)
                steps = np.unique(np.minimum((places * span).astype(int), span - 1))
                own, starts = zip(*((i, s) for i in own for s in _starts(len(items[i]), share, span)))
                keys = [self._keys(items[i][s:], steps) for i, s in zip(own, starts)]
                tables = [np.zeros(1 << 16, bool) for _ in steps]
                for key in keys:
                    for table, k in zip(tables, key):
                        table[k & 0xFFFF] = True
                last = np.array([key[-1] for key in keys], np.uint64)
                order = np.argsort(last)
                found = last[order], np.array(own)[order], np.array(starts)[order]
                self.classes.append((steps, tables, found))
            low = high

    def _keys(self, words: np.ndarray, steps: np.ndarray) -> list[int]:
        at = np.zeros(1, np.int64)
        key = np.zeros(1, np.uint64)
        keys, done = [], 0
        for step in steps:
            at = _walk(words, at, self.bits, done, step)
            done = step
            key = _fold(key, words.take(at, mode="clip"))
            keys.append(int(key[0]))
        return keys


def _starts(size: int, share: float, span: int) -> list[int]:
    """A repetition's offsets into an item."""
    room = size - span
    n = min(room // STRIDE, MOST_STARTS)
    if n < 2:
        return [int(share * size)]
    return sorted({int((k + share) * room / n) for k in range(n)} | {min(int(share * size), room)})


def _walk(words: np.ndarray, at: np.ndarray, bits: np.ndarray, done: int, step: int) -> np.ndarray:
    for j in range(done, step):
        read = words.take(at, mode="clip")
        read *= bits[j]
        read >>= np.uint64(63)
        at = at + read.view(np.int64)
    return at


def _fold(key: np.ndarray, read: np.ndarray) -> np.ndarray:
    return mix((key ^ read) * np.uint64(0x9E3779B97F4A7C15))


class Matcher:
    """Finds items (lists of words as hashes) in documents."""

    def __init__(self, texts: list[bytes], edits: float = EDITS, repetitions: int = len(OFFSETS)):
        found = words_of([normal_text(t) for t in texts])
        bounds = np.searchsorted(found.text, np.arange(len(texts) + 1))
        self.items = [found.hash[a:b] for a, b in zip(bounds, bounds[1:])]
        self.most = [int(edits * len(x) + 1e-9) for x in self.items]
        self.plans = [Plan(r, self.items) for r in range(repetitions)]
        self.unspaced: list[tuple[int, bytes]] = []
        short: dict[int, list[tuple[int, int]]] = {}
        for i, (item, text) in enumerate(zip(self.items, texts)):
            if not 0 < len(item) < LEAST_WORDS:
                continue
            if UNSPACED.search(text.decode("utf-8", "replace")):
                self.unspaced.append((i, b"".join(normal_text(text).split())))
            else:
                short.setdefault(len(item), []).append((int(windows(item, len(item))[0]), i))
        self.short = {
            size: (np.array([k for k, _ in sorted(own)], np.uint64), np.array([i for _, i in sorted(own)]))
            for size, own in short.items()
        }
        self.bits: list[dict[int, int]] = []
        for item in self.items:
            where: dict[int, int] = {}
            for i, word in enumerate(item.tolist()):
                where[word] = where.get(word, 0) | 1 << i
            self.bits.append(where)

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Rows (item, place where it would start, place that agreed) of windows that agree at a repetition's sampled steps."""
        padded = np.concatenate([words, np.zeros(4096, np.uint64)])
        rows = [np.zeros((0, 3), np.int64)]
        for first in range(0, len(words), _PASS_WORDS):
            n = min(_PASS_WORDS, len(words) - first)
            near = padded[first : first + n + 4096]
            folded = _fold(np.uint64(0), near)
            short = (folded & np.uint64(0xFFFF)).astype(np.uint16)
            for plan in self.plans:
                rows.extend(found + [0, first, first] for found in _pass(plan, near, folded, short, n))
        return np.concatenate(rows)

    def distance(self, item: int, words: list[int]) -> int:
        """Least edit distance of the item to any stretch of ``words`` (bit vectors, one column per word)."""
        where, n = self.bits[item], len(self.items[item])
        full, top = (1 << n) - 1, 1 << (n - 1)
        down, up, score, least = full, 0, n, n
        for word in words:
            match = where.get(word, 0)
            vertical = match | up
            horizontal = ((((match & down) + down) ^ down) | match) & full
            plus = up | (full ^ (horizontal | down))
            minus = down & horizontal
            score += bool(plus & top)
            score -= bool(minus & top)
            least = min(least, score)
            plus, minus = (plus << 1) & full, (minus << 1) & full
            down = (minus | (full ^ (vertical | plus))) & full
            up = plus & vertical
        return least

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, word at which the window starts), the nearest window of each text and item."""
        out = []
        for a, b in blocks([len(t) for t in texts]):
            normal = [normal_text(t) for t in texts[a:b]]
            found = words_of(normal)
            out.extend((a + text, *rest) for text, *rest in self._of(found, b - a))
            out.extend((a + text, *rest) for text, *rest in self._short(found, b - a))
            if self.unspaced:
                out.extend((a + i, *rest) for i, t in enumerate(normal) for rest in self._unspaced(t))
        return out

    def _short(self, found: Words, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Items under LEAST_WORDS words that stand in the texts word by word, the first place in each text."""
        bounds = np.searchsorted(found.text, np.arange(n + 1))
        for size, (keys, items) in self.short.items():
            read = windows(found.hash, size)
            place = np.flatnonzero(found.text[: len(read)] == found.text[size - 1 :][: len(read)])
            place = place[np.isin(read[place], keys)]
            low, high = (np.searchsorted(keys, read[place], side) for side in ("left", "right"))
            seen = set()
            for at, a, b in zip(place.tolist(), low.tolist(), high.tolist()):
                text = int(found.text[at])
                for item in items[a:b].tolist():
                    if (text, item) not in seen:
                        seen.add((text, item))
                        yield text, item, 0, at - int(bounds[text])

    def _unspaced(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """Items in scripts without spaces that stand in a text as a run of characters."""
        if text.isascii() or not UNSPACED.search(text.decode()):
            return
        words = text.split()
        ends = np.cumsum([len(w) for w in words])
        joined = b"".join(words)
        for item, key in self.unspaced:
            at = joined.find(key)
            if at >= 0:
                yield item, 0, int(np.searchsorted(ends, at, "right"))

    def _near(self, item: int, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Whether enough words around each start occur in the item: else no window there is near enough."""
        size, most = len(self.items[item]), self.most[item]
        around = starts[:, None] + np.arange(-most - 2, size + most + 2)
        read = words.take(around, mode="clip") & np.uint64(0xFFFF)
        known = np.zeros(1 << 16, bool)
        known[self.items[item] & np.uint64(0xFFFF)] = True
        return known[read].sum(1) >= size - most

    def _of(self, found: Words, n: int) -> Iterator[tuple[int, int, int, int]]:
        bounds = np.searchsorted(found.text, np.arange(n + 1))
        rows = self.candidates(found.hash)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        cuts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        for own in np.split(rows, cuts[1:]) if len(rows) else ():
            item = int(own[0, 0])
            size, most = len(self.items[item]), self.most[item]
            own = np.column_stack([own[:, 1], found.text[own[:, 2]]])  # the text in which the place that agreed stands
            for k in range(0, len(own), 4096):
                own_part = own[k : k + 4096]
                own[k : k + 4096, 1] = np.where(self._near(item, own_part[:, 0], found.hash), own_part[:, 1], -1)
            best: dict[int, tuple[int, int]] = {}
            for start, text in np.unique(own[own[:, 1] >= 0], axis=0).tolist():
                so_far = best.get(text, (most + 1, 0))[0]
                if so_far:
                    first, last = int(bounds[text]), int(bounds[text + 1])
                    low, high = max(start - most - 2, first), min(start + size + most + 2, last)
                    d = self.distance(item, found.hash[low:high].tolist())
                    if d < so_far:
                        best[text] = (d, max(start - first, 0))
            for text, (d, start) in best.items():
                yield text, item, d, start


def _pass(plan: Plan, words: np.ndarray, folded: np.ndarray, short: np.ndarray, n: int) -> Iterator[np.ndarray]:
    at, done = np.arange(n), 0
    alive = []
    for c in sorted(plan.classes, key=lambda c: c[0][0]):  # all places walk up to each class's first sampled step
        at = _walk(words, at, plan.bits, done, c[0][0])
        done = int(c[0][0])
        left = np.flatnonzero(c[1][0][short.take(at, mode="clip")])
        alive.append((c, left, at[left], folded.take(at[left], mode="clip")))
    for (steps, tables, (keys, items, offsets)), place, at, key in alive:
        for k in range(1, len(steps)):
            at = _walk(words, at, plan.bits, int(steps[k - 1]), int(steps[k]))
            key = _fold(key, words.take(at, mode="clip"))
            left = tables[k][key & np.uint64(0xFFFF)]
            place, at, key = place[left], at[left], key[left]
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        same = high - low
        at = np.repeat(low, same) + np.arange(same.sum()) - np.repeat(np.cumsum(same) - same, same)
        places = np.repeat(place, same)
        yield np.column_stack([items[at], places - offsets[at], places])


def _item_blocks(items: DataFrame, item_bytes: int) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """The items, at most about ``item_bytes`` at a time; each different (item_id, text) once."""
    rows = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // item_bytes)
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield [r["item_id"] for r in own], [r["text"].encode() for r in own]


def find_items(
    docs: DataFrame, items: DataFrame, edits: float = EDITS, repetitions: int = len(OFFSETS), item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """Matches of ``items`` (item_id, text) in whole ``docs`` (doc_id, text): doc_id, item_id, distance, item_words, start.

    One row per doc_id and item_id with the least distance (in words) found, and the word where that window starts. Null
    texts are empty and match nothing; items under five words match exactly only; null ids are kept as ids; rows that repeat an
    id give one row; other columns are ignored. Without documents or items there are no rows. Items are sent to the tasks in
    blocks of bounded size; each block is one pass over the documents.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, item_words int, start long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    out = spark.createDataFrame([], schema)
    for ids, texts in _item_blocks(items, item_bytes):
        sent = spark.sparkContext.broadcast((ids, texts))

        def of(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, texts = sent.value
            matcher = Matcher(texts, edits, repetitions)
            for batch in batches:
                docs_of = batch.column(0).to_pylist()
                found = matcher.matches([t or b"" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([docs_of[t] for t, *_ in found], pa.int64()),
                        pa.array([names[i] for _, i, *_ in found], pa.int64()),
                        pa.array([d for _, _, d, _ in found], pa.int32()),
                        pa.array([len(matcher.items[i]) for _, i, *_ in found], pa.int32()),
                        pa.array([s for *_, s in found], pa.int64()),
                    ],
                    ["doc_id", "item_id", "distance", "item_words", "start"],
                )

        out = out.unionByName(rows.mapInArrow(of, schema))
    best = F.min(F.struct("distance", "start", "item_words")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.distance", "b.item_words", "b.start")


def drop_contaminated(
    docs: DataFrame, items: DataFrame, edits: float = EDITS, repetitions: int = len(OFFSETS), item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, same columns.

    Rows are judged one by one, whatever their id: repeated rows are kept or go together, rows with null ids are judged alike. A
    null or empty text holds no item and stays. Without items all rows stay, without documents there are none.
    """
    spark = docs.sparkSession
    kept = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    schema = kept.schema
    text = docs.columns.index("text")
    for block in _item_blocks(items, item_bytes):
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value[1], edits, repetitions)
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
                hit = np.zeros(batch.num_rows, bool)
                hit[[t for t, *_ in matcher.matches(texts)]] = True
                yield batch.filter(pa.array(~hit))

        kept = kept.mapInArrow(clean, schema)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
