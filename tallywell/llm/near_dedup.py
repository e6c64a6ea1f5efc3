"""Near copies by Order MinHash on word shingles, verified by banded alignment.

Texts are compared as words in lower case without ASCII punctuation. A link is an edit similarity of words of at least
0.8: 1 - edit distance / words of the longer text. Texts without a word are linked to equal texts only.

A shingle is some words in a row, labelled with its occurrence number in the text. Each of ``SKETCHES`` hash functions
takes the two least shingles of a text and keeps them in text order, so a sketch tells the order of what it holds; texts with
an equal sketch are candidates. How many words make a shingle follows from the edits that a link allows wherever they stand: if
every fifth word is another, 0.34 of the union of shingles of three words stay, both of two with 0.12, and 40 sketches miss the
pair with 0.007. Shorter texts have few runs and take shingles of two words or one (``LENGTHS``).

Texts of a bucket meet like this, each step between texts that the steps before have not connected:

1. The least node of a bucket is its centre, and the others are its pairs. Lengths and bags of words bound the distance of a pair
   from below, so most unlike pairs go without a text being read. Each node is verified against its least centre.
2. The other pairs with centres are verified.
3. In buckets whose texts are still apart, bags are compared in blocks, and the pairs that remain are verified in tiles of a
   bounded number of pairs: a text moves once for a tile, not for each of its pairs, and only links leave a task.

So no two similar texts of a bucket stay unconnected, and texts are moved only for pairs that may be links.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.sharding import text_key
from tallywell.llm.words import blocks, mix, normal_text, windows, words_of
from tallywell.storage import materialize

SKETCHES, ORDER, SIMILARITY = 40, 2, 0.8
#: Words of a shingle, and of the longest text that has such shingles.
LENGTHS = ((1, 12), (2, 48), (3, 1 << 62))
#: Numbers that a bag of words is folded to; members of a bucket that make a block; pairs of a centre that a task verifies; pairs
#: of a tile.
BAG, BLOCK_ROWS, CENTRE_PAIRS, TILE_PAIRS = 256, 512, 2000, 8000
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NUMBERS = mix(np.arange(1, len(LENGTHS) * SKETCHES + 1, dtype=np.uint64)).reshape(len(LENGTHS), SKETCHES)


def _labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence numbers, as one hash each."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if new.all():
        return shingles
    place = np.arange(len(ranked))
    number = np.empty(len(ranked), np.uint64)
    number[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(shingles + number * np.uint64(0x9E3779B97F4A7C15))


def order_minhash(words: np.ndarray, shingle: int, order: int = ORDER) -> np.ndarray:
    """Sketches (uint64) of a text's word hashes; a text of fewer words than a shingle is one shingle; no words, none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    shingles = _labelled(windows(words, min(shingle, len(words))))
    order = min(order, len(shingles))
    out = np.zeros(SKETCHES, np.uint64)
    # A few hash functions at a time: memory stays a small multiple of the text.
    step = max(1, (1 << 18) // len(shingles))
    for k in range(0, SKETCHES, step):
        rank = shingles * _FACTORS[k : k + step, None]
        rank ^= rank >> np.uint64(29)
        least = np.empty((len(rank), order), np.int64)
        for j in range(order):
            least[:, j] = rank.argmin(axis=1)
            rank[np.arange(len(rank)), least[:, j]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least.sort(axis=1)  # text order
        chosen = np.zeros(len(rank), np.uint64)
        for j in range(order):
            chosen = chosen * np.uint64(0xD6E8FEB86659FD93) + shingles[least[:, j]]
        out[k : k + step] = mix(chosen)
    return out


def sketches_of(words: np.ndarray) -> np.ndarray:
    """All sketches of a text, with their number and kind mixed in; two similar texts have one kind in common."""
    out = [np.zeros(0, np.uint64)]
    least = 1.0
    for kind, (shingle, longest) in enumerate(LENGTHS):
        if least <= len(words) <= longest:
            out.append(order_minhash(words, shingle) ^ _NUMBERS[kind])
        least = SIMILARITY * longest  # a text just above ``longest`` may be similar to one of this length
    return np.concatenate(out)


def bag_of(words: np.ndarray) -> np.ndarray:
    """Words counted in ``BAG`` numbers by their hash, up to 255 each."""
    return np.minimum(np.bincount((words >> np.uint64(7)).astype(np.int64) % BAG, minlength=BAG), 255).astype(np.uint8)


def may_link(n: np.ndarray, m: np.ndarray, apart: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether texts of ``n`` and ``m`` words may be linked if their bags differ by ``apart`` in all.

    Each edit changes a bag by two at most (by one where a word comes or goes), and folding only hides differences.
    """
    longer, shorter = np.maximum(n, m), np.minimum(n, m)
    most = np.floor((1 - similarity) * longer + 1e-9)
    return (longer - shorter <= most) & (apart <= 2 * most - (longer - shorter))


def banded_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences, or ``most`` + 1 if it is larger.

    Only cells within ``most`` of the diagonal are computed, a column at a time: a column is two bit vectors of the steps
    between its cells.
    """
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    a, b = a[head:], b[head:]
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(b))
    if tail:
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not m or not most:
        return n if n <= most else most + 1
    most = min(most, n)
    where: dict[object, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    # Bit w - 1 is the row ``most`` below the diagonal.
    w = 2 * most + 1
    full, top = (1 << w) - 1, 1 << (w - 1)
    down = full ^ ((1 << (w - 1 - most)) - 1)
    up, distance, at, row = 0, most, most + 1 - w, top >> 1
    limit = most + m - (n - most)
    for j, y in enumerate(b):
        bits = where.get(y, 0)
        match = (bits >> at if at >= 0 else bits << -at) & full
        diagonal = ((((match & down) + down) ^ down) | match | up) & full
        right_up = up | (full ^ (diagonal | down))
        right_down = diagonal & down
        if j < n - most:
            distance += not diagonal & top
        else:
            distance += bool(right_up & row)
            distance -= bool(right_down & row)
            row >>= 1
        if distance > limit:
            return most + 1
        half = diagonal >> 1
        down = (right_down | (full ^ (half | right_up))) & full
        up = half & right_up
        at += 1
    return min(distance, most + 1)


def similar(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    """Whether the edit similarity reaches ``similarity``.

    First an exact bound: words that only one side has. Then bands of growing width, as near copies need a narrow one.
    """
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if longer - min(len(a), len(b)) > most:
        return False
    if longer - sum((Counter(a) & Counter(b)).values()) > most:
        return False
    band = 64
    while band < most:
        if banded_distance(a, b, band) <= band:
            return True
        band *= 8
    return banded_distance(a, b, most) <= most


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, 128 bits (a, b) of the text, its number of words and its sketches (with their number mixed in)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(3).to_pylist()
            sketches, sizes = [], []
            for a, b in blocks([len(t) for t in raw]):
                found = words_of([normal_text(t) for t in raw[a:b]])
                bounds = np.searchsorted(found.text, np.arange(b - a + 1))
                sizes.extend(np.diff(bounds).tolist())
                for i in range(b - a):
                    sketches.append(sketches_of(found.hash[bounds[i] : bounds[i + 1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "a", "b", "n", "sketches"],
            )

    rows = docs.select("doc_id", "key.a", "key.b", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(of, "doc_id long, a long, b long, n long, sketches array<long>")


def _bags(texts: DataFrame) -> DataFrame:
    """node, n, bag."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            sizes, bags = [], []
            for a, b in blocks([len(t or b"") for t in raw]):
                found = words_of([normal_text(t) for t in raw[a:b]])
                bounds = np.searchsorted(found.text, np.arange(b - a + 1))
                sizes.extend(np.diff(bounds).tolist())
                bags.extend(bag_of(found.hash[x:y]).tobytes() for x, y in zip(bounds[:-1], bounds[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["node", "n", "bag"]
            )

    return texts.select("node", "text").mapInArrow(of, "node long, n long, bag binary")


def _able(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (one, two) that may be links by their bags."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BAG) for c in (4, 5))
            n, m = (batch.column(c).to_numpy() for c in (2, 3))
            apart = np.abs(x.astype(np.int16) - y).sum(axis=1)
            keep = pa.array(may_link(n, m, apart, similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["one", "two"])

    one, two = (bags.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bag").alias(f"bag_{c}")) for c in ("one", "two"))
    both = pairs.join(one, "one").join(two, "two").select("one", "two", "n_one", "n_two", "bag_one", "bag_two")
    return both.mapInArrow(of, "one long, two long")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The links among ``pairs`` (one, two).

    A text moves beside its pairs' ``two``, then to the task of their ``one``, whose own text comes once for ``CENTRE_PAIRS`` of them.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for batch in batches:
            found = []
            for one, part, two, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if two is None:
                    last, words = (one, part), normal_text(text).split()
                elif (one, part) != last:
                    raise ValueError("a pair without its text")
                elif similar(words, normal_text(text).split(), similarity):
                    found.append((one, two))
            columns = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["one", "two"])

    parts = pairs.groupBy("one").agg(F.ceil(F.count("*") / CENTRE_PAIRS).alias("parts"))
    asked = pairs.join(parts, "one").select("one", F.pmod(F.xxhash64("two"), F.col("parts")).alias("part"), "two")
    theirs = asked.join(texts.select(F.col("node").alias("two"), "text"), "two").select("one", "part", "two", "text")
    own = parts.join(texts.select(F.col("node").alias("one"), "text"), "one").select(
        "one", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("two"), "text"
    )
    met = own.unionByName(theirs).repartition("one", "part").sortWithinPartitions("one", "part", F.asc_nulls_first("two"))
    return materialize(met.mapInArrow(of, "one long, two long"), "near-links")


def block_pairs(rows: list[tuple], first: int, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs (one < two) that may be links, of a block or of two blocks that meet at row ``first`` (else 0).

    ``rows``: node, root, number of words, bag. Nodes of one root are connected already.
    """
    node, root, n = (np.array([row[c] for row in rows], np.int64) for c in range(3))
    bag = np.frombuffer(b"".join(row[3] for row in rows), np.uint8).reshape(-1, BAG).astype(np.int16)
    out = []
    for i in range(first or len(rows)):
        others = np.arange(first or i + 1, len(rows))
        longer, shorter = np.maximum(n[others], n[i]), np.minimum(n[others], n[i])
        near = (longer - shorter <= np.floor((1 - similarity) * longer + 1e-9)) & (root[others] != root[i])
        others = others[near]
        if len(others):
            apart = np.abs(bag[others] - bag[i]).sum(axis=1)
            for j in others[may_link(n[others], n[i], apart, similarity)].tolist():
                out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
    return out


def tiles_of(pairs: list[tuple[int, int]], anchors: set[int]) -> Iterator[list[tuple[int, list[int]]]]:
    """``pairs`` in tiles of about ``TILE_PAIRS``: all nodes of a tile, each with those of its partners that it is to be compared with.

    The ends among ``anchors`` (else the first ends) hold the partners, so a tile is some of them and what they meet.
    """
    met: dict[int, list[int]] = {}
    for one, two in pairs:
        held, other = (two, one) if two in anchors and one not in anchors else (one, two)
        met.setdefault(held, []).append(other)
    tile: dict[int, list[int]] = {}
    n = 0
    for held, others in met.items():
        tile.setdefault(held, []).extend(others)
        for other in others:
            tile.setdefault(other, [])
        n += len(others)
        if n >= TILE_PAIRS:
            yield list(tile.items())
            tile, n = {}, 0
    if tile:
        yield list(tile.items())


def _tiles_verified(tiles: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The links (one < two) of ``tiles`` (bucket, kind, low, x, y, tile, node, partners)."""
    cells = ["bucket", "kind", "low", "x", "y", "tile"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, asked = None, {}, []

        def close() -> pa.RecordBatch:
            found = []
            for node, partners in asked:
                words = normal_text(held[node]).split()
                found += [
                    (min(node, p), max(node, p)) for p in partners if similar(words, normal_text(held[p]).split(), similarity)
                ]
            columns = zip(*found) if found else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["one", "two"])

        for batch in batches:
            for *now, node, partners, text in zip(*(batch.column(c).to_pylist() for c in range(9))):
                if now != key:
                    if asked:
                        yield close()
                    key, held, asked = now, {}, []
                held[node] = text
                if partners:
                    asked.append((node, partners))
        if asked:
            yield close()

    met = tiles.join(texts.select("node", "text"), "node").select(*cells, "node", "partners", "text")
    met = met.repartition(*cells).sortWithinPartitions(*cells, "node")
    return materialize(met.mapInArrow(of, "one long, two long"), "near-links")


def _crowded(members: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Tiles of the pairs that may be links, of ``members`` (bucket, node, n, root) that share a bucket, not a root.

    A row is a node of a tile (bucket, kind, low, x, y, tile, node, partners). A pair that shares several such buckets is in a tile
    of the least one only.

    Of each bucket the largest root is the base, as a group of near copies may hold most of it: its members only meet the rest, the
    rest meet each other as well. Both are dealt out in blocks of bounded size and like length, and blocks whose lengths rule
    each other out don't meet; only pairs leave a task.
    """
    held = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    base = held.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("base"), F.count("*").alias("_roots"))
    base = base.where("_roots > 1").select("bucket", "base")
    band = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / F.log(F.lit(1 / similarity)) + 1e-9).cast("int")
    rows = materialize(members.join(base, "bucket").withColumn("band", band), "near-apart")
    if rows.isEmpty():
        return rows.select(
            "bucket", *[F.lit(0).alias(c) for c in ("kind", "low", "x", "y", "tile")], "node", F.array("node").alias("partners")
        )
    # What a node brings joins its rows before they are dealt out. It has at most as many buckets as sketches.
    known = rows.groupBy("node").agg(F.collect_list("bucket").alias("own")).join(bags.select("node", "bag"), "node")
    rows = materialize(rows.join(known, "node"), "near-apart-bags")
    rest, based = rows.where("root <> base"), rows.where("root = base")
    blocks_of = lambda name: F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name)
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def cell(kind: int, low: Column, x: Column, y: Column, side: Column | int) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), low.cast("int").alias("low"), x.cast("int").alias("x"), y.cast("int").alias("y"),
            (F.lit(side) if isinstance(side, int) else side.cast("int")).alias("side"),
        )

    # The rest with each other: within a band blocks x <= y, and each block with those of the next band.
    sizes = rest.groupBy("bucket", "band").agg(blocks_of("parts"))
    after = sizes.select("bucket", (F.col("band") - 1).alias("band"), F.col("parts").alias("next"))
    before = sizes.select("bucket", (F.col("band") + 1).alias("band"), F.col("parts").alias("last"))
    plan = sizes.join(after, ["bucket", "band"], "left").join(before, ["bucket", "band"], "left").na.fill(0, ["next", "last"])
    placed = rest.join(plan, ["bucket", "band"]).withColumn("part", deal("parts"))
    own, part = F.col("band"), F.col("part")
    inner = F.transform(upto("parts"), lambda o: cell(0, own * 2, F.least(part, o), F.greatest(part, o), part > o))
    up = F.transform(upto("next"), lambda o: cell(0, own * 2 + 1, part, o, 0))
    down = F.transform(upto("last"), lambda o: cell(0, own * 2 - 1, o, part, 1))
    among = placed.select("bucket", "node", "root", "n", "own", "bag", F.explode(F.concat(inner, up, down)).alias("m"))

    # The base of a band with the rest of that band and the two beside it.
    near = rest.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    plan = based.groupBy("bucket", "band").agg(blocks_of("parts")).join(
        near.groupBy("bucket", "band").agg(blocks_of("others")), ["bucket", "band"])
    mine = based.join(plan, ["bucket", "band"]).withColumn("part", deal("parts"))
    mine = mine.select("bucket", "node", "root", "n", "own", "bag", F.explode(F.transform(upto("others"), lambda o: cell(1, own, part, o, 1))).alias("m"))
    theirs = near.join(plan, ["bucket", "band"]).withColumn("part", deal("others"))
    theirs = theirs.select("bucket", "node", "root", "n", "own", "bag", F.explode(F.transform(upto("parts"), lambda o: cell(1, own, o, part, 0))).alias("m"))
    dealt = among.unionByName(mine).unionByName(theirs).select("bucket", "m.*", "node", "root", "n", "own", "bag")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, first = None, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            across = key[1] or key[2] % 2 or key[3] != key[4]
            pairs = [] if across and not 0 < first < len(held) else block_pairs(held, first if across else 0, similarity)
            own = {row[0]: set(row[4]) for row in held}
            pairs = [(a, b) for a, b in pairs if min(own[a] & own[b]) == key[0]]
            for number, tile in enumerate(tiles_of(pairs, {row[0] for row in held[:first]} if across else set())):
                columns = [pa.array([x] * len(tile), t) for x, t in zip([*key, number], [pa.int64(), *[pa.int32()] * 5])]
                nodes, partners = zip(*tile)
                columns += [pa.array(nodes, pa.int64()), pa.array(partners, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [*cells, "tile", "node", "partners"])

        for batch in batches:
            for *now, side, node, root, n, bag, own in zip(*(batch.column(c).to_pylist() for c in range(11))):
                if now != key:
                    if held:
                        yield from close()
                    key, held, first = now, [], 0
                if not side:
                    first += 1
                held.append((node, root, n, bag, own))
        if held:
            yield from close()

    cells = ["bucket", "kind", "low", "x", "y"]
    dealt = dealt.select(*cells, "side", "node", "root", "n", "bag", "own").repartition(*cells).sortWithinPartitions(*cells, "side", "node")
    tiles = dealt.mapInArrow(of, "bucket long, kind int, low int, x int, y int, tile int, node long, partners array<long>")
    return materialize(tiles, "near-tiles")


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the root that ``roots`` (node, root; as from ``_components``) gives, their own if none."""
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _links(nodes: DataFrame, docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Verified links (one < two) that connect all similar nodes which share a sketch, and the roots they lead to; see the steps above."""
    exploded = nodes.select("node", "n", F.explode("sketches").alias("bucket"))
    sizes = exploded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.max("node").alias("_last"))
    sizes = sizes.where("c.node <> _last").select("bucket", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"))
    members = materialize(exploded.join(sizes, "bucket"), "near-members")
    asked = members.where("node <> centre")

    def near(n: str, m: str) -> Column:
        longer, shorter = F.greatest(n, m), F.least(n, m)
        return longer - shorter <= F.floor((1 - similarity) * longer + 1e-9)

    close = asked.where(near("n", "centre_n"))
    first = materialize(close.groupBy(F.col("node").alias("two")).agg(F.min("centre").alias("one")).select("one", "two"), "near-first")

    # Texts of nodes that may have a link: with a centre, or in a bucket with others than the centre.
    several = asked.groupBy("bucket").agg(F.min("node").alias("_a"), F.max("node").alias("_b")).where("_a <> _b").select("bucket")
    inner = asked.join(several, "bucket", "left_semi").select("node")
    wanted = close.select("node").unionByName(close.select(F.col("centre").alias("node"))).unionByName(inner)
    wanted = materialize(nodes.join(wanted.distinct(), "node").select("node", "a", "b", "least_id", "n", "sketches"), "near-wanted")
    rows = docs.select("doc_id", F.col("key.a").alias("a"), F.col("key.b").alias("b"), F.col("text").cast("binary").alias("text"))
    texts = materialize(
        rows.join(wanted.select("node", "a", "b", "least_id"), ["a", "b"]).where(F.col("doc_id").eqNullSafe(F.col("least_id")))
        .select("node", "text").dropDuplicates(["node"]),
        "near-texts",
    )
    bags = materialize(_bags(texts), "near-bags")

    links = _verified(materialize(_able(first, bags, similarity), "near-able"), texts, similarity)
    roots = _components(links)

    def with_centres() -> DataFrame:
        """The other pairs with centres; those that are connected already leave no row of the join."""
        own = _rooted(wanted, roots).select("node", "n", "root", F.explode("sketches").alias("bucket"))
        centres = members.where("node = centre").select("bucket", "centre", "centre_n")
        told = centres.join(roots.select(F.col("node").alias("centre"), F.col("root").alias("centre_root")), "centre", "left")
        told = told.withColumn("centre_root", F.coalesce("centre_root", "centre"))
        met = own.join(told, (own["bucket"] == told["bucket"]) & (F.col("root") != F.col("centre_root")) & near("n", "centre_n"))
        return _able(met.select(F.col("centre").alias("one"), F.col("node").alias("two")).distinct(), bags, similarity)

    def with_others() -> DataFrame:
        own = _rooted(wanted, roots).select("node", "n", "root", F.explode("sketches").alias("bucket"))
        others = own.join(members.where("node = centre").select("bucket", "centre"), "bucket").where("node <> centre").drop("centre")
        return _crowded(others, bags, similarity)

    rest = materialize(with_centres().join(first, ["one", "two"], "left_anti"), "near-rest")
    for step in (lambda: _verified(rest, texts, similarity), lambda: _tiles_verified(with_others(), texts, similarity)):
        new = step()
        if not new.isEmpty():
            links = materialize(links.unionByName(new), "near-links")
            roots = _joined(roots, new)
    return links, roots


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root; as from ``_components``) once ``links`` connect them: only their roots are contracted."""
    ends = roots.select(F.col("node").alias("end"), "root")
    for end in ("one", "two"):
        links = links.join(ends.withColumnRenamed("end", end), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    further = materialize(_components(links), "near-roots")
    over = further.select(F.col("node").alias("root"), F.col("root").alias("over"))
    told = roots.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    return materialize(told.unionByName(further), "near-roots")


def _components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that chains of links lead to; nodes that are their own root are left out.

    Large star, then small star, until every node has one edge, to a node that has none itself: the number of rounds grows with
    the logarithm of the longest chain, and links that are stars already need none. The edges of each round are a stored table.
    """
    edges = links.where("one <> two").select(F.greatest("one", "two").alias("one"), F.least("one", "two").alias("two")).distinct()
    edges = materialize(edges, "near-edges")
    while True:
        n, nodes = edges.agg(F.count("*"), F.count_distinct("one")).first()
        ends = edges.select(F.col("two").alias("one")).distinct()
        if n == nodes and edges.join(ends, "one", "left_semi").isEmpty():
            return edges.select(F.col("one").alias("node"), F.col("two").alias("root"))
        both = edges.unionByName(edges.select(F.col("two").alias("one"), F.col("one").alias("two")))
        least = both.groupBy("one").agg(F.least("one", F.min("two")).alias("m"))
        large = (
            both.where("two > one").join(least, "one").select(F.col("two").alias("one"), F.col("m").alias("two")).distinct()
        )
        lowest = large.groupBy("one").agg(F.min("two").alias("m"))
        moved = large.join(lowest, "one").where("two <> m").select(F.col("two").alias("one"), F.col("m").alias("two"))
        edges = materialize(
            moved.unionByName(lowest.select("one", F.col("m").alias("two"))).distinct(), "near-edges"
        )


def _classified(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, a, b), nodes (node, a, b, least_id, root) and links."""
    sketched = materialize(_sketched(docs), "near-sketches")
    # Equal texts have equal sketches, so any row's will do.
    distinct = sketched.groupBy("a", "b").agg(
        F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("sketches").alias("sketches")
    )
    nodes = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    links, roots = _links(nodes, docs, similarity)
    rooted = nodes.drop("sketches", "n").join(roots, "node", "left")
    return sketched.drop("sketches", "n"), rooted.withColumn("root", F.coalesce("root", "node")), links


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))


def near_classes(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links.

    Rows with equal texts (null counts as empty) are one node. A class is all texts that chains of links connect, with all
    their copies; ``class_id`` is its least doc_id (null if all are null); ``n_links`` counts the verified links of the text
    to other texts. Repeated rows give repeated rows, no rows give none; other columns are ignored.
    """
    rows, nodes, links = _classified(_keyed(docs, text), similarity)
    ends = links.select(F.col("one").alias("node")).unionByName(links.select(F.col("two").alias("node")))
    counted = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    # Stored, so that the join below is one that Spark can split for a large class.
    classes = materialize(nodes.groupBy("root").agg(F.min("least_id").alias("class_id")), "near-classes")
    told = nodes.join(classes, "root").join(counted, "node", "left")
    return rows.join(told.select("a", "b", "class_id", "n_links"), ["a", "b"]).select(
        "doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def keep_one(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, same columns: that of the least doc_id (nulls last, ties by text, then any equal row)."""
    rows, nodes, _ = _classified(_keyed(docs, text), similarity)
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "a", "b"))
    chosen = nodes.groupBy("root").agg(first.alias("w")).select("w.a", "w.b", F.col("w.least_id").alias("_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    winners = materialize(
        rows.join(chosen, ["a", "b"]).where(same).groupBy("a", "b", "_id").agg(F.count("*").alias("_n")), "near-winners"
    )
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    keyed = docs.select(*own, F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col(text)).alias("_k"))
    met = keyed.join(winners, (F.col("_k.a") == F.col("a")) & (F.col("_k.b") == F.col("b")) & same)
    kept = met.where("_n = 1")
    if not winners.where("_n > 1").isEmpty():
        kept = kept.unionByName(met.where("_n > 1").dropDuplicates(["a", "b", "_id"]))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
