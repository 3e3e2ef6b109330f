import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from omnimart.llm import token_files
from omnimart.llm.wavelet import WaveletMatrix
from omnimart.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 5000])
def test_wavelet_matrix_against_an_array(n):
    ids = np.random.RandomState(n).choice([0, 1, 5, 50_256, 65_535, 77], n)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, 16).to_bytes())
    assert np.array_equal(matrix.decode(), ids)
    for i in range(0, n, max(1, n // 50)):
        assert matrix.access(i) == ids[i]
    for value in (0, 5, 50_256, 65_535, 3, 1 << 20):
        where = np.flatnonzero(ids == value)
        assert matrix.count(value) == len(where)
        assert matrix.count(value, n // 3, n - n // 4) == np.count_nonzero((where >= n // 3) & (where < n - n // 4))
        for k in range(0, len(where), max(1, len(where) // 20)):
            assert matrix.locate(value, k) == where[k]
        with pytest.raises(IndexError):
            matrix.locate(value, len(where))


def texts():
    draw = random.Random(9)
    alphabet = ["a", "b", "Z", "é", "ß", "漢", "😀", "1", "²", "½", " ", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x1c", "'s", "'", ".", "!!", "_", "<|endoftext|>", "ª", "word", " the", "İ"]
    return ["".join(draw.choices(alphabet, k=draw.randrange(1, 60))) for _ in range(1500)]


def test_chunks_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    encoder, own = token_files.byte_level_encoder(PATH), texts()
    found = [ids[cut[k] : cut[k + 1]].tolist() for at, end, ids, cut, _, _ in encoder.pieces(pa.array(own)) for k in range(end - at)]
    assert found == [e.ids for e in tokenizer.encode_batch(own, add_special_tokens=False)]


def expected(pairs, end_id):
    from tokenizers import Tokenizer

    tokenizer, start, rows = Tokenizer.from_file(PATH), 0, []
    tokenizer.encode_special_tokens = True
    for i, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        rows.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_files_round_trip(spark, documents):
    pairs = [*enumerate(texts()[:300], start=-100), (1000, None), (1001, ""), (1002, "long text " * 40_000), (1003, "x"), (1003, "a"), (None, "null id")]
    random.Random(1).shuffle(pairs)
    where = scratch_path(spark, "shards")
    token_files.write_shards(documents(pairs).repartition(5), PATH, 2, where, shard_tokens=1000)
    found = sorted((tuple(r) for r in token_files.read_documents(spark, where).collect()), key=lambda r: r[1])
    assert found == expected(pairs, 2)
    shards = token_files.read_shards(spark, where).collect()
    sizes = [len(r.ends) > 1 and r.ends[-1] > 1000 for r in shards]
    assert len(shards) > 10 and not any(sizes)
    files = spark.read.schema(token_files.SHARD).parquet(where).select("_metadata.file_name").distinct().count()
    assert files == len(shards)


def test_count_and_first_place(spark, documents):
    pairs = [(i, t) for i, t in enumerate(texts()[:50])]
    where = scratch_path(spark, "shards")
    token_files.write_shards(documents(pairs), PATH, 2, where, shard_tokens=200)
    flat = []
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    for _, t in pairs:
        flat += tokenizer.encode(t, add_special_tokens=False).ids + [2]
    for token in (2, flat[0], 49_000):
        rows = token_files.count_token(spark, where, token).collect()
        assert sum(r.n for r in rows) == flat.count(token)
        places = [r.first for r in rows if r.n]
        assert not places or min(places) == flat.index(token)


def test_empty_table_and_extra_columns(spark, documents):
    where = scratch_path(spark, "shards")
    token_files.write_shards(documents([]), PATH, 2, where)
    assert token_files.read_documents(spark, where).count() == 0
    where = scratch_path(spark, "shards")
    token_files.write_shards(spark.createDataFrame([(1, "a", 5, 6)], "doc_id long, text string, shard long, start long"), PATH, 2, where)
    assert [tuple(r)[:3] for r in token_files.read_documents(spark, where).collect()] == [(1, 0, 2)]
