"""Token shards and piece spans against the libraries themselves."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkloom.llm import pieces
from linkloom.llm import token_store as T

WORD_FILE, PIECE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(WORD_FILE)
TEXTS = st.text(alphabet="aB é,.!'s<|>\n\t ́ßİſK2½日😀\x1c", max_size=40)
ODD = [None, "", " ", "a<|endoftext|>b c", "<|startoftext|> x <| y|> <|STARTOFTEXT|>", "it's I'LL 42 don't, x. y.. ,z", "x" * 3000, "Ünder., é,", "a\x1cb\x85c d"]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_words_give_the_same_ids(texts):
    ids, n = T.coder(WORD_FILE).encode([*texts, *ODD])
    parts = np.split(ids, np.cumsum(n)[:-1])
    assert [p.tolist() for p in parts] == [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in [*texts, *ODD]]


def test_small_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 10)
    c = T.WordCoder(WORD_FILE)
    for n in range(6):
        text = " ".join(f"word{n}{k}, and" for k in range(30))
        assert c.encode([text])[0].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert len(c.slot) < 200


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    h = T.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    index = T.Index(T.index_bytes(keys, np.arange(len(keys) + 1), 2))
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()


def test_shards(spark):
    rows = [(k * 37 % 101, f"document {k} says é {k * k}") for k in range(101)] + [(500, None), (501, ""), (502, "long " * 50_000), (7, "again"), (None, "lost")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").repartition(4)
    manifest = T.write_shards(docs, WORD_FILE, T.shared_uri(spark, "tokens-test"))
    got = sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in T.read_shards(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(i for i, _ in rows if i is not None)
    at, texts = 0, {}
    for i, t in rows:
        texts.setdefault(i, set()).add(bytes(np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, T.END_ID], "<u4").tobytes()))
    for i, start, n, ids in got:
        assert start == at and len(ids) == 4 * n and ids in texts[i]
        at += n
    shards = [r.asDict() for r in manifest.collect()]
    assert T.lookup(shards, 502).tolist()[-1] == T.END_ID and len(T.lookup(shards, 502)) == 50_001
    assert T.lookup(shards, 10_000) is None
    empty = T.write_shards(docs.limit(0), WORD_FILE, T.shared_uri(spark, "tokens-test"))
    assert empty.count() == 0 and T.read_shards(empty).count() == 0


def test_token_query(spark):
    from linkloom.llm.queries import op7_token_store

    root = "/root/testdata/sf0.001"
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op7_token_store(spark, root).collect()}
    at, expected = 0, {}
    for r in spark.read.parquet(f"{root}/documents.parquet").orderBy("doc_id").collect():
        ids = [*TOKENIZER.encode(r.text or "", add_special_tokens=False).ids, 1]
        expected[r.doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert rows == expected


# --- pieces -----------------------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é▁\n\t日😀\x01 <s>", max_size=30))
def test_spans_are_the_pieces(text):
    c = pieces.codec(PIECE_FILE)
    (ids,) = c.encode([text])
    start, end = c.spans(text, ids)
    raw = text.encode()
    assert ids.tolist() == c.model.encode(text, add_bos=True, add_eos=True)
    assert (start[1:] >= start[:-1]).all() and start[0] == end[0] == 0 and (len(ids) == 2 or end[-1] == len(raw))
    covered = bytearray()
    for s, e, piece in zip(start[1:-1], end[1:-1], (c.model.id_to_piece(int(i)) for i in ids[1:-1])):
        part = raw[s:e]
        if piece.startswith("<0x"):
            assert int(piece[3:5], 16) in part  # one byte of the character that the span covers
        elif not (piece == "▁" and s == e == 0):
            assert part.decode().replace(" ", "▁") == (piece if s else piece.removeprefix("▁") if not part.startswith((b" ", "▁".encode())) or len(part.decode()) < len(piece) else piece)
        if s >= len(covered):
            covered += part
    assert bytes(covered) == raw


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_follows_the_compiled_map(rule):
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    spec = proto.normalizer_spec
    own = pieces.Normaliser(pieces.read_charsmap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
    for text in ["ﬁ ① Å x　y", "  a  ﬃ ", "が x", "ABC①②   \t k", "", " ", "Ａ́é 한국", "½ kg​x", "à́b"]:
        body, begin, end = own(text.encode())
        assert body.decode() == library.normalize(text)
        raw = text.encode()
        assert len(begin) == len(end) == len(body)
        assert all(b <= e and raw[b:e].decode() is not None for b, e in zip(begin, end)) and (np.diff(begin) >= 0).all()


def test_piece_operator(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "héllo wörld", 0), (3, "héllo wörld", 0), (None, "x y " * 60_000, 0)], "doc_id long, text string, n_tokens int")
    rows = sorted(pieces.encode_pieces(docs, PIECE_FILE).collect(), key=lambda r: r.doc_id or 9)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    for r, text in zip(rows, ["", "", "héllo wörld", "héllo wörld", "x y " * 60_000]):
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == model.decode(ids) and len(r.starts) == len(r.ends) == len(r.ids)
    assert pieces.encode_pieces(docs.limit(0), PIECE_FILE).count() == 0
