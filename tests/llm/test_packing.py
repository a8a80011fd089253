import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lotmill.llm.packing import karmarkar_karp, op3_karmarkar_karp_packing, pack_block, pack_documents
from lotmill.llm.token_cache import CachedEncoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, window):
    """Pieces against the tokenizer itself, and their places in sequences."""
    ids = [np.array(e.ids + [2], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts.values()], add_special_tokens=False)]
    ids = dict(zip(texts, ids))
    covered = {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length > 0 and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc, parts in covered.items():
        assert sum(n for _, n in parts) == len(ids[doc]) and [s for s, _ in sorted(parts)] == list(np.cumsum([0] + [n for _, n in sorted(parts)])[:-1])
    assert set(covered) == set(texts)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sum(r.length for r in rows) / (window * len(sequences))


def test_differencing():
    assert sorted(map(sorted, karmarkar_karp([8, 7, 6, 5, 4], 2))) == [[0, 2], [1, 3, 4]]  # 14 and 16, as the textbook has it
    rng = random.Random(0)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(0, 40))]
        windows = rng.randint(1, 8)
        got = karmarkar_karp(sizes, windows)
        assert sorted(k for w in got for k in w) == list(range(len(sizes))) and len(got) == windows
        loads = [sum(sizes[k] for k in w) for w in got]
        assert max(loads) - min(loads) <= max(sizes, default=0)


def test_windows_rise_until_all_fits():
    assert len(pack_block([3, 3, 3, 3], 6)) == 2 and len(pack_block([4, 4, 4], 6)) == 3 and pack_block([], 6) == []


def test_query(spark, sf_dir, tokenizer):
    rows = op3_karmarkar_karp_packing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check(rows, texts, tokenizer, 4096) > 0.93


def test_edges(spark, tokenizer):
    texts = {1: "a", 2: None, 3: "", 4: "very long " * 20_000, 5: "Émile, <|endoftext|> ok…", 6: "x" * 5000, 7: "\x1c odd　white\xa0space"}
    df = spark.createDataFrame([(i, t, 9) for i, t in texts.items()], "doc_id long, text string, start int")
    got = pack_documents(df, PATH, window=256, block=16)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(got.collect(), texts, tokenizer, 256)
    with_ids = pack_documents(df, PATH, window=256, block=16, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)
    assert pack_documents(df.limit(0), PATH).count() == 0
    twice = pack_documents(df.unionByName(df).withColumn("doc_id", df.doc_id * 0 + 1), PATH, window=256).collect()
    assert sum(r.start == 0 for r in twice) == 2 * len(texts)
    nulls = spark.createDataFrame([(None, "a b c"), (None, None)], "doc_id long, text string")
    assert [r.doc_id for r in pack_documents(nulls, PATH).collect()] == [None, None]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_encoder_is_the_tokenizer(name):
    rng = random.Random(2)
    signs = list("abcAB  \n\t.,!'_-09éÉßñ") + ["\x1c", "\xa0", " ", "Σ", "ς", "ﬁ", "é", "İ", "中", "'s", " \n", "  ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "й", "й", "ǅ", "\x00", "🙂", "½", "Ⅷ", "\r\n", "\u0327", "\u0331", "\u030a", "\u0301", "H", "W", "J"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["", " ", "a" * 3000 + " b", "\n\na", "a\n", "İ\u0327", "H\u0331 W\u030a J\u030c"]
    encoder = CachedEncoder(public_tokenizers.path(name), max_words=3000)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for k in range(0, len(texts), 300) for x in encoder.encode(texts[k : k + 300])]
    assert got == want and encoder.kind != "plain"
    assert any(max(x, default=0) == plain.token_to_id("<|endoftext|>") for x in want)
    assert len(encoder.young) + len(encoder.old) < 2 * 3000  # two generations, rotated between calls


def test_words_come_back_from_the_older_generation():
    encoder = CachedEncoder(PATH, max_words=8)
    first = encoder.encode(["one two three four five six"])[0].tolist()
    assert encoder.old and "one" not in encoder.young
    assert encoder.encode(["one two three four five six"])[0].tolist() == first


def test_short_texts_fill_windows(spark, tokenizer):
    texts = {k: f"word number {k} here" for k in range(30_000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    assert check(pack_documents(df, PATH).collect(), texts, tokenizer, 4096) > 0.97


def test_large_ids_beside_null(spark):
    ids = [None, 9007199254740993, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in pack_documents(df, PATH).collect()} == set(ids)
    names = spark.createDataFrame([("x", "a"), (None, "b")], "doc_id string, text string")
    assert {r.doc_id for r in pack_documents(names, PATH).collect()} == {"x", None}


def test_a_task_lets_go_of_its_words(spark, monkeypatch, tokenizer):
    works = []
    df = spark.range(1).selectExpr("id AS doc_id", "'' AS text")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, work, schema: works.append(work) or self)
    pack_documents(df, PATH)
    texts = {k: f"word{k} and others" for k in range(500)}
    for _ in range(2):  # the second task meets all words anew
        batch = pa.RecordBatch.from_pydict({"doc_id": list(texts), "__text": list(texts.values())})
        rows = [(r["doc_id"], r["ids_crc32"]) for out in works[0](iter([batch])) for r in out.to_pylist()]
        wanted = [np.array(e.ids + [2], "<u4") for e in tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)]
        assert sorted(rows) == [(k, zlib.crc32(ids.tobytes())) for k, ids in enumerate(wanted)]
        held = encoder(PATH)
        assert held.young == held.pinned and not held.old
