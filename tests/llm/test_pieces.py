import numpy as np
import pytest

from colmask.llm import pieces as p
from tests.conftest import rows
from tests.llm.helpers import no_docs, odd_docs, table

TEXTS = [
    "", "a", " ", "  x  y ", "\n\n", "▁ a▁b", "日本語 \U0001f600 é\x00\xa0z", "x" * 500, " " * 40, "á  ",
    "The cat's (end), 12.5%\tok", "�", "ab" * 3000,
]


@pytest.fixture(scope="module")
def vocab():
    return p.Vocabulary.load()


def plain_best(text, vocab):
    """The best score, by trying all pieces from all places of the whole text."""
    data = b" " + text.encode()
    normal = {x: i for i, x in enumerate(vocab.pieces) if x and i not in set(vocab.byte_ids.tolist())}
    begins = [i for i in range(len(data)) if data[i] & 0xC0 != 0x80] + [len(data)]
    best = dict.fromkeys(begins, -np.inf) | {0: 0.0}
    for n, i in enumerate(begins[:-1]):
        after = begins[n + 1]
        if data[i:after] not in normal:
            best[after] = max(best[after], best[i] + vocab.fallback)
        for j in begins[n + 1 : n + 60]:
            if data[i:j] in normal:
                best[j] = max(best[j], best[i] + vocab.scores[normal[data[i:j]]])
    return best[len(data)]


def score(ids, vocab):
    """The score of a segmentation: a run of byte pieces counts once for each character."""
    total, held = 0.0, b""
    in_bytes = set(vocab.byte_ids.tolist())
    for i in ids:
        if i not in in_bytes:
            total += vocab.scores[i]
            continue
        held += vocab.pieces[i]
        try:
            held.decode()
        except UnicodeDecodeError:
            continue
        total, held = total + vocab.fallback, b""
    return total


def test_best_segmentation_and_exact_text(spark, vocab):
    texts = TEXTS + [r["text"] for r in table(spark, "documents").limit(40).collect()]
    for text, raw in zip(texts, p.Encoder(vocab).encode([t.encode() for t in texts])):
        ids = np.frombuffer(raw, np.int32)
        assert b"".join(vocab.pieces[i] for i in ids).removeprefix(b" ").decode() == text
        if text:
            assert score(ids, vocab) == pytest.approx(plain_best(text, vocab), abs=1e-6)


def test_all_pieces_are_in_the_trie(vocab):
    trie = vocab.trie
    in_bytes = set(vocab.byte_ids.tolist())
    found = 0
    for i, piece in enumerate(vocab.pieces):
        if not piece or i in in_bytes:
            continue
        node = 0
        for c in piece:
            to = trie.base[node] + c + 1
            assert trie.check[to] == node
            node = to
        found += trie.value[node] == i
    assert found > 31_000


def test_own_scores_and_ties():
    bytes_ = [bytes([b]) for b in range(256)]
    own = {256: -1.0, 257: -1.0, 258: -2.0, 259: -0.5, 260: -1.5}
    vocab = p.Vocabulary.of(bytes_ + [b"a", b"b", b"ab", b" ", b" a"], own, np.arange(256, dtype=np.int32))
    assert vocab.fallback == -12.0

    def ids(text):
        return np.frombuffer(p.Encoder(vocab).encode([text.encode()])[0], np.int32).tolist()

    # " a" + "b" and " " + "ab" and three single pieces all score -2.5: the longest last piece wins.
    assert ids("ab") == [259, 258]
    assert ids("c") == [259, 99]
    assert ids("é b") == [259, 195, 169, 259, 257]


def test_a_piece_with_a_space_inside():
    bytes_ = [bytes([b]) for b in range(256)]
    vocab = p.Vocabulary.of(bytes_ + [b"a", b" ", b"a a"], {256: -1.5, 257: -1.0, 258: -0.5}, np.arange(256, dtype=np.int32))
    assert np.frombuffer(p.Encoder(vocab).encode([b"a a"])[0], np.int32).tolist() == [257, 258]


def test_long_words_are_cut_the_same(vocab, monkeypatch):
    texts = [t.encode() for t in TEXTS] + [("日本語" + "ab" * 40 + "é\U000f0001").encode() * 30, b"x" * 50_000]
    want = p.Encoder(vocab).encode(texts)
    monkeypatch.setattr(p, "LONG_WORD", 0)
    assert p.Encoder(vocab).encode(texts) == want
    monkeypatch.setattr(p, "LONG_WORD", 10**9)
    assert p.Encoder(vocab).encode(texts) == want


def test_forgetting_words_changes_nothing(vocab, monkeypatch):
    texts = [f"some words {i} and x{i * i} more".encode() for i in range(200)]
    want = p.Encoder(vocab).encode(texts)
    for name, value in (("CACHE_BYTES", 900), ("CUT_BYTES", 10), ("WORDS_AT_ONCE", 7)):
        monkeypatch.setattr(p, name, value)
    assert p.Encoder(vocab).encode(texts) == want


def test_decoding_ids_that_encoding_does_not_give(spark, vocab):
    cut = int(vocab.byte_ids[0xE6])
    frame = spark.createDataFrame([(1, [cut]), (2, []), (3, None), (4, [1, 2])], "k int, ids array<int>")
    got = rows(p.decode_pieces(frame, "ids", "text", vocab), "k", "text")
    assert got == [(1, "�"), (2, ""), (3, None), (4, "")]


def test_odd_rows(spark):
    docs = odd_docs(spark, ["ids", "decoded", "n_pieces"])
    got = p.encoded_documents(docs).collect()
    assert len(got) == docs.count() and all(r["round_trip"] for r in got)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[2]["ids"] is None and by_id[2]["n_pieces"] == 0
    assert by_id[3]["ids"] == []
    assert by_id[7]["n_bytes"] > 0
    assert by_id[5]["n_pieces"] > 60_000
    assert p.encoded_documents(no_docs(spark)).count() == 0


def test_query(spark):
    got = p.op4_pieces(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)


def test_memory_of_remembered_words_is_bounded(vocab, monkeypatch):
    monkeypatch.setattr(p, "CACHE_BYTES", 20_000)
    encoder = p.Encoder(vocab)
    for i in range(30):
        encoder.encode([b" ".join(b"w%d" % (i * 100 + j) for j in range(100)), b"x" * (70 + i), b"y" * 5000])
        assert encoder.size <= 20_000
        assert encoder.size == sum(len(w) + len(v) + p.CACHE_ENTRY for w, v in encoder.known.items())
        assert max(map(len, encoder.known), default=0) <= p.CACHE_WORD
