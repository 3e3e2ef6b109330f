import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from omnimart.llm import sentencepiece_codec as codec

PATH = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    draw = random.Random(2)
    parts = ["the", "The", " ", " ", "  ", "   ", "\n", "\t", "é", "漢字", "😀", "▁", "▁▁", "<s>", "</s>", "<unk>", "<0x0A>", "123", ".", "ing", "tion", " ", "\x00", "naïve", "ß"]
    return ["".join(draw.choices(parts, k=draw.randrange(1, 40))) for _ in range(800)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_equal_the_library(spark, documents, library):
    own = texts()
    found = codec.decode(codec.encode(documents(list(enumerate(own))).repartition(3), PATH), PATH).collect()
    for r in found:
        assert r.token_ids == library.encode(r.text)
        assert r.decoded == r.text.replace("▁", " ")
    assert sorted(codec.encode(documents(list(enumerate(own))), PATH, back=True).collect()) == sorted(found)


def test_whole_texts_without_chunks(library):
    tokenizer = codec.Model.read(PATH).tokenizer(whole=True)
    own = texts()[:100]
    assert [e.ids for e in tokenizer.encode_batch(own, add_special_tokens=False)] == library.encode(own)


def test_parity_failure_is_an_error(monkeypatch):
    monkeypatch.setattr(codec.Model, "merges", lambda self: [])
    encoder = codec._encoder(PATH, 1, True)
    with pytest.raises(ValueError, match="sentencepiece"):
        list(encoder.pieces(pa.array(["the thing"])))


def unigram_model(path, join_blanks):
    """A small unigram model file with byte fallback, written field by field."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def block(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind):
        return block(1, block(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + bytes([3 << 3, kind]))

    pieces = [piece("<unk>", 0, 2), piece("<s>", 0, 3), piece("</s>", 0, 3)]
    pieces += [piece(f"<0x{k:02X}>", 0, 6) for k in range(256)]
    pieces += [piece(t, -2.0 - k / 7, 1) for k, t in enumerate(["▁", "▁the", "th", "e", "t", "h", "in", "i", "n", "g", "ing", "▁th", "▁▁", "a"])]
    trainer = bytes([3 << 3, 1]) + varint(35 << 3) + b"\1"
    normal = block(1, b"identity") + bytes([3 << 3, 1, 4 << 3, int(join_blanks), 5 << 3, 1])
    path.write_bytes(b"".join(pieces) + block(2, trainer) + block(3, normal))
    return str(path)


@pytest.mark.parametrize("join_blanks", [False, True])
def test_unigram_models(tmp_path, join_blanks):
    path = unigram_model(tmp_path / "u.model", join_blanks)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = codec.Model.read(path)
    assert model.kind == codec.UNIGRAM and model.byte_fallback and model.by_chunks() is not join_blanks
    own = ["the thing", "a  the", " the ", "thé in", "ing", "   ", "the\nthing a"]
    encoder = codec._encoder(path, 1, True)
    found = [ids[cut[k] : cut[k + 1]].tolist() for at, end, ids, cut, _, _ in encoder.pieces(pa.array(own)) for k in range(end - at)]
    assert found == library.encode(own)


def test_edge_rows(spark, documents):
    long_text = "a very long text " * 50_000
    rows = documents([(1, None), (2, ""), (3, long_text), (3, long_text), (None, "x")])
    found = codec.decode(codec.encode(rows, PATH), PATH).collect()
    assert [(r.doc_id, r.token_ids == [], r.decoded == (r.text or "")) for r in found if r.doc_id in (1, 2)] == [(1, True, True), (2, True, True)]
    assert all(r.decoded == (r.text or "") for r in found) and len(found) == 5
    ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [tuple(r) for r in codec.decode(ids, PATH).collect()] == [(1, None, None), (2, [], "")]


def test_empty_table_and_clashes(spark, documents):
    assert codec.decode(codec.encode(documents([]), PATH), PATH).count() == 0
    rows = spark.createDataFrame([(1, "a", [1])], "doc_id long, text string, token_ids array<int>")
    with pytest.raises(ValueError):
        codec.encode(rows, PATH)
    with pytest.raises(ValueError):
        codec.decode(rows.withColumnRenamed("text", "decoded"), PATH)
