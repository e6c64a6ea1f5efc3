"""Token ids in binary segments with Elias-Fano boundaries.

File format: a Parquet folder with one row per segment, a run of whole documents in ascending order.

- ``part``, ``segment``: place of the segment; ``base``: ids before it within its part;
- ``n_docs``, ``n_ids``, ``width`` (bytes per id, 2 or 4);
- ``ids``: all ids of the segment, little-endian;
- ``ends``: Elias-Fano code of the ends of the documents (ids up to and with each document);
- ``names``: Elias-Fano code of the doc_ids less ``first_name``; ``n_unnamed`` null doc_ids come first.

Elias-Fano keeps n ascending numbers up to u in about n * (2 + log2(u / n)) bits: the low bits as they are, the high
bits in unary. ``select(i)`` finds the i-th 1 of the high bits from a sample for each 256, without 64-bit tables.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywell.llm.words import blocks, words_of
from tallywell.storage import fresh_path

SEGMENT_IDS = 1 << 20
END_ID = 2
_SAMPLE = 256
_HEAD = struct.Struct("<QBQ")

Encode = Callable[[list[bytes]], list[np.ndarray]]


# --- Elias-Fano ----------------------------------------------------------------------------------------------


def ef_encode(values: np.ndarray) -> bytes:
    """Code of ascending numbers (>= 0): head, low bits, high bits, one sampled place for each 256 numbers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    low = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
    lows = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    low_bytes, high_bytes = np.packbits(lows.ravel(), bitorder="little"), np.packbits(high, bitorder="little")
    return b"".join([
        _HEAD.pack(n, low, len(high_bytes)), low_bytes.tobytes(), high_bytes.tobytes(),
        ones[::_SAMPLE].astype("<u4").tobytes(),
    ])


class EliasFano:
    """Reads a code: ``len``, ``select(i)``, ``all()``."""

    def __init__(self, code: bytes):
        self.n, self.low, n_high = _HEAD.unpack_from(code)
        at = _HEAD.size
        n_low = -(-self.n * self.low // 8)
        self._lows = code[at : at + n_low]
        self._high = np.frombuffer(code, np.uint8, n_high, at + n_low)
        self._samples = np.frombuffer(code, "<u4", -(-self.n // _SAMPLE), at + n_low + n_high)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The i-th number."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, rest = int(self._samples[i // _SAMPLE]), i % _SAMPLE
        byte, chunk = at // 8, 64
        skip = at % 8
        while True:
            bits = np.unpackbits(self._high[byte : byte + chunk], bitorder="little")
            ones = np.flatnonzero(bits[skip:]) + skip
            if rest < len(ones):
                place = byte * 8 + int(ones[rest])
                break
            rest, byte, skip = rest - len(ones), byte + chunk, 0
        first = i * self.low
        raw = int.from_bytes(self._lows[first // 8 : (first + self.low + 7) // 8], "little")
        return (place - i) << self.low | raw >> first % 8 & (1 << self.low) - 1

    def all(self) -> np.ndarray:
        """All numbers, decoded at once."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n].astype(np.uint64)
        bits = np.unpackbits(np.frombuffer(self._lows, np.uint8), bitorder="little")[: self.n * self.low]
        lows = bits.reshape(self.n, self.low).astype(np.uint64) << np.arange(self.low, dtype=np.uint64)
        return ((ones - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low)) | lows.sum(1, dtype=np.uint64)


# --- tokenizer -----------------------------------------------------------------------------------------------


#: White space that a text must not hold to be encoded word by word: the code points that may be white space anywhere, and
#: runs of it.
_OTHER_WHITE = [chr(c).encode() for c in range(0x2000) if chr(c).isspace() and chr(c) not in " \n"]
_WIDE_WHITE = [chr(c).encode() for c in range(0x2000, 0x3001) if chr(c).isspace()]
_RUNS = [b"  ", b"\n\n", b" \n", b"\n "]


def _is_plain(text: bytes) -> bool:
    """Whether all white space is single spaces and line ends between words (one line end may close the text)."""
    if text[:1] in (b" ", b"\n") or text[-1:] == b" " or any(map(text.__contains__, _RUNS + _OTHER_WHITE)):
        return False
    return not ((b"\xe2" in text or b"\xe3" in text) and any(map(text.__contains__, _WIDE_WHITE)))


class KnownWords:
    """Ids of words by hash: sorted hashes, and where the ids of each lie in one array. About 30 bytes a word."""

    def __init__(self, id_type: str):
        self.hash = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.zeros(0, id_type)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is known."""
        place = np.searchsorted(self.hash, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == keys[inside]
        return place, known

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, ids])
        order = np.argsort(keys)
        place = np.searchsorted(self.hash, keys[order])
        self.hash = np.insert(self.hash, place, keys[order])
        self.at = np.insert(self.at, place, at[order])
        self.size = np.insert(self.size, place, sizes[order])


@functools.cache  # one per Python worker: its tasks share what has been learnt
def byte_bpe(path: str, pattern: str, remember: int = 2_000_000) -> Encode:
    """Encoder for a byte-level vocabulary of the tokenizers library: UTF-8 texts to arrays of ids.

    Such a vocabulary encodes each match of ``pattern`` by itself, with the space before it. So each different word is given
    to the library once and its ids are remembered (``remember`` words, then all are forgotten); a text's ids are those
    of its words in a row. That holds where all white space is single spaces and line ends; other texts go to the
    library whole. Strings of special tokens in a text are ordinary text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    wide = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
    opens_word = np.zeros(tokenizer.get_vocab_size(), bool)  # ids whose bytes start with a space
    opens_word[[i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token.startswith("\u0120")]] = True

    def ids_of(text: bytes) -> np.ndarray:
        whole = tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(whole[0].ids, wide)

    line_end = ids_of(b"\n")
    if len(line_end) != 1:
        raise ValueError("the vocabulary has no line end")
    known = KnownWords(wide)
    bare = np.uint64(0xA0761D6478BD642F)  # marks words without a space before them

    def encode_words(words: list[bytes], mark: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, and how many each has: words are encoded in one text, its ids cut where words start."""
        all_ids, all_sizes = [np.zeros(0, wide)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 5000):
            own = words[k : k + 5000]
            ids = ids_of(mark + mark.join(own))
            starts = np.flatnonzero(opens_word[ids] if mark == b" " else ids == line_end[0])
            if len(starts) != len(own):
                raise ValueError("the vocabulary does not keep words apart")
            sizes = np.diff(np.append(starts, len(ids)))
            if mark == b"\n":
                ids, sizes = np.delete(ids, starts), sizes - 1
            all_ids.append(ids)
            all_sizes.append(sizes)
        return np.concatenate(all_ids), np.concatenate(all_sizes)

    def encode_plain(texts: list[bytes]) -> list[np.ndarray]:
        data = b"\n".join(texts) + b"\n"
        words = words_of(texts)
        raw = np.frombuffer(data, np.uint8)
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        text_starts = np.concatenate([[0], text_ends[:-1]])
        opens_text = words.start == text_starts[words.text]
        spaced = ~opens_text & (raw[np.maximum(words.start - 1, 0)] == 32)
        key = np.where(spaced, words.hash, words.hash ^ bare)
        unique, first, back = np.unique(key, return_index=True, return_inverse=True)
        place, found = known.find(unique)
        if not found.all():
            if len(known.hash) + len(unique) > remember:
                known.__init__(wide)
                found[:] = False
            new = first[~found]
            keys, is_spaced = unique[~found], spaced[new]
            strings = [data[a:b] for a, b in zip(words.start[new].tolist(), words.end[new].tolist())]
            inner, other = np.flatnonzero(is_spaced), np.flatnonzero(~is_spaced)
            made = [encode_words([strings[i] for i in own], mark) for own, mark in ((inner, b" "), (other, b"\n"))]
            ids, sizes = (np.concatenate(x) for x in zip(*made))
            known.add(keys[np.concatenate([inner, other])], sizes, ids)
            place, _ = known.find(unique)
        place = place[back]
        size, at = known.size[place], known.at[place]
        breaks = (~opens_text & ~spaced).astype(np.int64)
        closes = np.array([t[-1:] == b"\n" for t in texts], np.int64)
        # Words of a text, then the line end that closes it.
        total = np.bincount(words.text, size + breaks, minlength=len(texts)).astype(np.int64) + closes
        ends = np.cumsum(total)
        out = np.full(int(ends[-1]) if len(ends) else 0, line_end[0], wide)
        before = np.cumsum(size + breaks) - size + np.concatenate([[0], np.cumsum(closes)])[words.text]
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(before, size) + within] = known.pool[np.repeat(at, size) + within]
        return np.split(out, ends[:-1])

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        plain = [_is_plain(t) for t in texts]
        found = iter(encode_plain([t for t, p in zip(texts, plain) if p]) if any(plain) else ())
        return [next(found) if p else ids_of(t) for t, p in zip(texts, plain)]

    return encode


# --- write and read ------------------------------------------------------------------------------------------

SEGMENT_SCHEMA = (
    "part int, segment int, base long, n_docs long, n_ids long, width int, ids binary, ends binary, "
    "first_name long, n_unnamed long, names binary"
)


def write_tokens(
    docs: DataFrame, path: str, encoder: Callable[[], Encode], end_id: int = END_ID, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``path`` in ascending doc_id order.

    Null doc_ids come first, equal ones in the order of a hash of the text, so a repeated id is spread over tasks. Null texts
    are empty: their ids are the end id alone. Other columns are ignored; no rows write no segments. A segment ends once it
    holds ``segment_ids``, and keeps ids in two bytes if all fit; a task holds one segment and one Arrow batch at a time. Spark's committer drops the files of
    failed attempts.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(), TaskContext.get().partitionId()
        state = {"segment": 0, "base": 0}
        names: list[int | None] = []
        runs: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            unnamed = sum(n is None for n in names)
            own = np.array(names[unnamed:], np.int64)
            first = int(own[0]) if len(own) else 0
            ids = np.concatenate(runs)
            width = 2 if int(ids.max()) < 1 << 16 else 4  # a segment has at least an end id
            row = {
                "part": part, "segment": state["segment"], "base": state["base"], "n_docs": len(names), "n_ids": len(ids),
                "width": width, "ids": ids.astype(f"<u{width}").tobytes(), "ends": ef_encode(np.cumsum([len(r) for r in runs])),
                "first_name": first, "n_unnamed": unnamed, "names": ef_encode((own - first).view(np.uint64)),
            }
            state["segment"] += 1
            state["base"] += len(ids)
            names.clear()
            runs.clear()
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT_ARROW)

        total = 0
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            own = batch.column(0).to_pylist()
            for a, b in blocks([len(t) for t in texts], 4 << 20):
                for name, found in zip(own[a:b], encode(texts[a:b])):
                    names.append(name)
                    runs.append(np.append(found.astype(np.uint32), np.uint32(end_id)))
                    total += len(found) + 1
                    if total >= segment_ids:
                        yield flush()
                        total = 0
        if names:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


_SEGMENT_ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("base", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
    ("width", pa.int32()), ("ids", pa.binary()), ("ends", pa.binary()), ("first_name", pa.int64()),
    ("n_unnamed", pa.int64()), ("names", pa.binary()),
])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the ids before each in the whole store. Only the sizes of parts are summed in one task."""
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    joined = stored.join(F.broadcast(offsets), "part")  # one row per part
    return joined.withColumn("start", F.col("_before") + F.col("base")).drop("_before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the store: doc_id, start, n_tokens (with the end id), ids_crc32 (of ids as little-endian uint32)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = EliasFano(row["ends"]).all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                own = EliasFano(row["names"]).all().view(np.int64) + row["first_name"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * row["n_unnamed"] + own.tolist(), pa.int64()),
                        pa.array(starts + row["start"], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = "ends", "ids", "width", "names", "first_name", "n_unnamed", "start"
    return read_segments(spark, path).select(*columns).mapInArrow(
        of, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def document_ids(segment: dict, i: int) -> np.ndarray:
    """Ids of the i-th document of a segment row, found by select."""
    ends = EliasFano(segment["ends"])
    start = ends.select(i - 1) if i else 0
    width = segment["width"]
    return np.frombuffer(segment["ids"], f"<u{width}", ends.select(i) - start, start * width)


def store_documents(docs: DataFrame, encoder: Callable[[], Encode], **options: int) -> DataFrame:
    """Write ``docs`` to a new folder of the shared one and read the documents back from its files."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, encoder, **options)
    return read_documents(docs.sparkSession, path)
