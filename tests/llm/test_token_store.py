import zlib

import numpy as np
import pytest

from tallywell.llm import token_store
from tallywell.llm.queries import vocabulary
from tallywell.llm.token_store import EliasFano, document_ids, ef_encode
from tallywell.storage import fresh_path


def encoder():
    return token_store.byte_bpe(*vocabulary())


def in_task():
    """Workers can't import this module, so what they call is made here."""
    return lambda: token_store.byte_bpe(*vocabulary())


@pytest.mark.parametrize("values", [
    [], [0], [7], [0, 0, 1, 5, 1000, 1_000_000], [3] * 600, list(range(0, 100_000, 7)), [2**62, 2**63], list(range(1000)),
])
def test_elias_fano(values):
    code = EliasFano(ef_encode(np.array(values, np.uint64)))
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(len(code))] == values
    with pytest.raises(IndexError):
        code.select(len(values))


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    bits = 8 * len(ef_encode(ends)) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 1


def test_words_give_the_ids_of_whole_texts(documents):
    from tokenizers import Tokenizer

    texts = [r.text for r in documents.collect()]
    texts += ["", "\n", "a\n", " a", "a ", "a \nb", "a\n b", "a  b", "x\ty", " x", "don't\n's 's", "<|endoftext|> x", "\x1c\x85 　", "1 22\n\n\n3"]
    whole = Tokenizer.from_file(vocabulary()[0])
    whole.encode_special_tokens = True
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    small = token_store.byte_bpe(*vocabulary(), remember=500)
    raw = [t.encode() for t in texts]
    for encode in (encoder(), small):
        assert [x.tolist() for k in range(0, len(raw), 40) for x in encode(raw[k : k + 40])] == want


def expected(rows, encode):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.append(encode([(text or "").encode()])[0], 2).astype("<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [1, 5000, 1 << 20])
def test_files_hold_all_documents(spark, documents, segment_ids):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    path = fresh_path(spark, "test-tokens")
    token_store.write_tokens(documents, path, in_task(), segment_ids=segment_ids)
    got = sorted(tuple(r) for r in token_store.read_documents(spark, path).collect())
    assert got == expected(rows, encoder())
    segment = token_store.read_segments(spark, path).orderBy("start").first().asDict()
    for i in range(min(3, segment["n_docs"])):
        assert document_ids(segment, i).tolist() == [*encoder()([rows[i][1].encode()])[0].tolist(), 2]


def test_odd_rows(spark, odd, none):
    got = token_store.store_documents(odd, in_task(), segment_ids=1000).collect()
    want = {(d, n, c) for d, _, n, c in expected([(r.doc_id, r.text) for r in odd.collect()], encoder())}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == odd.count()
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id or -1 for r in ordered] == sorted(r.doc_id or -1 for r in ordered)
    assert token_store.store_documents(none, in_task()).count() == 0


def test_ids_of_any_size(spark):
    """Large vocabularies: a segment takes four bytes an id where two don't hold them."""
    rows = [(1, "a"), (2, "b"), (3, "c"), (4, None)]

    def encoder():
        import numpy as np

        sizes = {b"a": [1, 2], b"b": [70_000, 3], b"c": [1 << 31]}
        return lambda texts: [np.array(sizes.get(t, []), np.uint32) for t in texts]

    path = fresh_path(spark, "wide")
    token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, encoder, segment_ids=1)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_store.read_documents(spark, path).collect()}
    want = {1: [1, 2, 2], 2: [70_000, 3, 2], 3: [1 << 31, 2], 4: [2]}
    assert got == {k: (len(v), zlib.crc32(np.array(v, "<u4"))) for k, v in want.items()}
    assert sorted(r.width for r in token_store.read_segments(spark, path).collect()) == [2, 2, 4, 4]


def test_words_of_like_hashes_in_other_schemes(spark):
    """Words whose polynomial hashes are equal for any odd root: their ids are their own."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary()[0])
    for texts in ([one, other], [f"x {one} y", f"x {other} y", one]):
        got = encoder()([t.encode() for t in texts])
        assert [x.tolist() for x in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
