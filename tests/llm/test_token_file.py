import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotmill.llm.common import stage_path
from lotmill.llm.token_file import TokenFile, TokenFileWriter, bits_for, op9_bit_packed_tokens, pack_bits, read_token_files, unpack_bits, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    for n in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype(np.uint32)
        raw = pack_bits(ids, bits)
        assert len(raw) == -(-n // 64) * 8 * bits and (unpack_bits(raw, n, bits) == ids).all()
    assert bits_for(50257) == 16 and bits_for(65536) == 16 and bits_for(65537) == 17 and bits_for(1) == 1


def test_random_access():
    rng = np.random.default_rng(5)
    docs = [(k, rng.integers(0, 50257, rng.integers(0, 300)).astype(np.uint32)) for k in range(100)] + [(None, np.arange(1000, dtype=np.uint32))]
    writer = TokenFileWriter(16, block_ids=128)
    raw = b"".join(writer.add(i, ids) for i, ids in docs) + writer.finish()
    read = TokenFile(io.BytesIO(raw))
    flat = np.concatenate([ids for _, ids in docs])
    for start, stop in ((0, 0), (0, 1), (100, 300), (127, 129), (len(flat) - 1, len(flat)), (0, len(flat))):
        assert (read.read(start, stop) == flat[start:stop]).all()
    assert [(i, ids.tolist()) for i, ids in read.documents()] == [(i, ids.tolist()) for i, ids in docs]
    with pytest.raises(ValueError):
        TokenFile(io.BytesIO(b"x" * 200))


def expected(rows):
    plain = Tokenizer.from_file(PATH)
    out, at = [], 0
    for (i, _), e in zip(rows, plain.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array(e.ids + [0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = op9_bit_packed_tokens(spark, sf_dir)
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == expected(rows)


def test_edges(spark):
    rows = [(None, "a"), (1, None), (2, ""), (3, "long " * 100_000), (4, "é <|endoftext|> x<|endoftext|>"), (9007199254740993, "x"), (2**63 - 1, "y")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    out = stage_path(spark, "tokens")
    manifest = write_token_files(df, PATH, out, block_ids=1000)
    got = read_token_files(manifest, out, with_ids=True).orderBy("start").collect()
    assert [tuple(r)[:4] for r in got] == expected(rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    twice = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a")], "doc_id long, text string")
    assert sorted(r.start for r in read_token_files(write_token_files(twice, PATH, out + "2"), out + "2").collect()) == [0, 2, 4]
    assert read_token_files(write_token_files(df.limit(0), PATH, out + "3"), out + "3").count() == 0
