import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallywell.llm import packing
from tallywell.llm.packing import pack_counts, pack_documents, sequences
from tallywell.llm.queries import vocabulary


def path():
    return vocabulary("word_bpe_49k.json")[0]


def encoder():
    own = path()
    return lambda: packing.word_bpe(own)


def library(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path())
    whole.encode_special_tokens = True
    return [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_runs_give_the_ids_of_whole_texts(documents):
    texts = [r.text for r in documents.collect()]
    texts += ["", "\n", "a\n", " a", "A b́ ́x é", "x\ty  z", "don't I'll 's", "<|endoftext|> x", "\x1c\x85 　y", "1 22", "\x01 a\x01b \x01\x01", "ǄİΣ σΣ"]
    raw = [t.encode() for t in texts]
    for remember in (2_000_000, 500):
        encode = packing.word_bpe(path(), remember)
        assert [x.tolist() for k in range(0, len(raw), 40) for x in encode(raw[k : k + 40])] == library(texts)


def best_fit_decreasing(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, length)
        n += i == len(gaps)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        bisect.insort(gaps, gap - length)
    return n


def unpacked(counts, capacity):
    """Sequences as lists of (offset, length), from the placements of all ranks."""
    placements, total = pack_counts(counts, capacity)
    held, ranks = {}, Counter()
    for p in placements:
        assert p.first == ranks[p.length]
        ranks[p.length] += p.n
        for k in range(p.n):
            held.setdefault(p.sequence + k // p.each, []).append((p.offset + k % p.each * p.length, p.length))
    assert ranks == Counter({k: n for k, n in counts.items() if n})
    assert sorted(held) == list(range(total))
    for own in held.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return held


@pytest.mark.parametrize("seed", range(25))
def test_packing_of_counts(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100, 2048])
    lengths = [min(capacity, int(rng.paretovariate(0.6)) if seed % 2 else rng.randint(1, capacity)) for _ in range(rng.randint(1, 3000))]
    held = unpacked(Counter(lengths), capacity)
    assert len(held) <= best_fit_decreasing(lengths, capacity)
    assert len(held) <= 11 / 9 * -(-sum(lengths) // capacity) + 1 or len(held) == best_fit_decreasing(lengths, capacity)
    assert all(sum(3 * n > capacity for _, n in own) <= 2 for own in held.values())


def fewest_for_large(lengths, capacity):
    """Fewest bins for items above a third: all but the pairs that two pointers find, the smallest with the largest that fits."""
    own = sorted(lengths)
    a, b, n = 0, len(own) - 1, 0
    while a <= b:
        a += a < b and own[a] + own[b] <= capacity
        b -= 1
        n += 1
    return n


@pytest.mark.parametrize("seed", range(20))
def test_large_items_are_matched_best(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(34, 100) for _ in range(rng.randint(1, 400))]
    assert len(unpacked(Counter(lengths), 100)) == fewest_for_large(lengths, 100)


def test_counts_of_any_size():
    """Work follows from the number of lengths, not of pieces."""
    placements, total = pack_counts({n: 10**12 for n in range(1, 2049)}, 2048)
    assert len(placements) < 50_000
    assert total < 1.02 * sum(n * 10**12 for n in range(1, 2049)) / 2048
    assert pack_counts({}, 2048) == ([], 0)


def check(rows, docs, capacity=2048):
    want = Counter()
    for (doc_id, text), ids in zip(docs, library([t or "" for _, t in docs])):
        ids = np.array([*ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            own = ids[k : k + capacity]
            want[doc_id, k // capacity, k, len(own), zlib.crc32(own.tobytes()), own.tobytes()] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= capacity
    assert len(held) <= best_fit_decreasing([r.length for r in rows], capacity)
    return held


def test_documents(spark, documents):
    for frame in (documents, documents.repartition(5)):
        packed = pack_documents(frame, encoder())
        rows = packed.collect()
        held = check(rows, [(r.doc_id, r.text) for r in documents.collect()])
        made = {r.sequence_id: r for r in sequences(packed).collect()}
        assert set(made) == set(held)
        for r in rows:
            assert bytes(made[r.sequence_id].ids)[4 * r.offset :][: 4 * r.length] == bytes(r.ids)
        assert {k: r.n_pieces for k, r in made.items()} == {k: len(v) for k, v in held.items()}


def test_odd_rows(spark, odd, none):
    check(pack_documents(odd, encoder(), capacity=64).collect(), [(r.doc_id, r.text) for r in odd.collect()], 64)
    check(pack_documents(odd, encoder()).collect(), [(r.doc_id, r.text) for r in odd.collect()])
    assert pack_documents(none, encoder()).count() == 0
