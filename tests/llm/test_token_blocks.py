import zlib
from collections import Counter

import numpy as np
import pytest
from casemill.llm import token_blocks as tb
from casemill.llm.queries import tokenizer
from casemill.session import scratch_path
from tokenizers import Tokenizer

TOK = tokenizer("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 5, 64, 1000, 70_000])
@pytest.mark.parametrize("block", [1, 64, 1024])
def test_blocks_round_trip(n, block):
    if n > 1000 and block == 1:
        return
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.03, rng.integers(0, 1 << 32, n, np.uint64), rng.integers(100, 900, n, np.uint64)).astype(np.uint32)
    raw = tb.pack_shard(3, 4, [None, 7], [n, 0], ids, block, 0.9)
    major, minor, docs, back = tb.unpack_shard(raw)
    assert (major, minor, raw[-1]) == (3, 4, 0) and docs["null"].tolist() == [1, 0] and np.array_equal(back, ids)


def test_outliers_do_not_widen_blocks():
    ids = np.full(1024, 1000, np.uint32)
    ids[::100] = 49_000
    assert len(tb.pack_blocks(ids, 1024, 0.95)[0]) < 100
    with pytest.raises(ValueError):
        tb.unpack_shard(b"\0" * 64)


TEXTS = ["", " ", "Hello  World's\n\ttab\rx", "<|endoftext|> mid<|startoftext|>x", "É́ é ｆｕｌｌ Σς", "123 4,5!!  don't",
         "w " * 5000, "x" * 3000, "　wide space\x85nel", "a\x00b"]


def expected(rows):
    tok = Tokenizer.from_file(TOK)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [1, 50, 1 << 20])
def test_files_equal_brute_force(spark, docs, shard_tokens):
    rows = [(i * 7, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (500, None), (-3, "minus")]
    path = scratch_path(spark, "tokens-test")
    tb.write_token_files(docs(*rows).selectExpr("*", "1 AS tie", "2 AS blob"), TOK, path, shard_tokens=shard_tokens, block=16)
    got = sorted((tuple(r) for r in tb.document_index(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_sf_table_repeated_ids_and_empty(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "tokens-test")
    tb.write_token_files(d, TOK, path)
    got = sorted((tuple(r) for r in tb.document_index(spark, path).collect()), key=lambda r: r[1])
    assert got == expected([tuple(r) for r in d.collect()])
    path = scratch_path(spark, "tokens-test")
    tb.write_token_files(docs((1, "b"), (1, "a"), (1, "b")), TOK, path)
    got = sorted(tuple(r) for r in tb.document_index(spark, path).collect())
    assert [g[:3] for g in got] == [(1, 0, 2), (1, 2, 2), (1, 4, 2)]
    path = scratch_path(spark, "tokens-test")
    tb.write_token_files(docs(), TOK, path)
    assert tb.document_index(spark, path).count() == 0


@pytest.mark.parametrize("text", ["same words", "", None])
def test_a_row_that_is_a_third_of_all_is_parted(spark, docs, text):
    rows = [(i, f"text {i % 5}") for i in range(120)] + [(60, text)] * 60 + [(None, "null id")] * 8
    parts = tb.dealt(docs(*rows), equal_rows=7)
    got = Counter((r.doc_id, None if r.text is None else bytes(r.text).decode()) for r in parts.collect())
    assert got == Counter(rows)
    places = sorted(r.place for r in parts.where("doc_id = 60").collect())
    assert places == sorted([0, *range(60)])
    spread = parts.repartitionByRange(8, "doc_id", "tie", "place").where("doc_id = 60")
    assert spread.selectExpr("spark_partition_id() AS p").distinct().count() > 1
    path = scratch_path(spark, "tokens-test")
    tb.write_token_files(docs(*rows), TOK, path, shard_tokens=50, equal_rows=7)
    got = sorted((tuple(r) for r in tb.document_index(spark, path).collect()), key=lambda r: r[1])
    want = expected(rows)
    assert [g[0] for g in got] == [w[0] for w in want] and sorted(g[2:] for g in got) == sorted(w[2:] for w in want)
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]


PIECES = ["a", "Ab", "é", "É", "T\u0308", "I\u0307", "'s", "'S", ".", ",", "..", "3", "x.", "<|", "<|ENDOFTEXT|>", "<|endoftext|>", "\n", " ", "  ", "\t",
          "\u0301", "ß", "Σς", "!", "_", "\u2028", "K", "Word,", "word. ", "it's. ", "日本。", "x\u00a0y"]


def test_chunked_ids_equal_the_library_on_mixed_texts():
    import random

    r = random.Random(8)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    whole = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(TOK).encode_batch(texts, add_special_tokens=False)]
    enc = tb.Encoder(TOK, limit=60)
    assert enc.separable and enc.points and enc.caseless
    for at in range(0, len(texts), 50):
        assert enc.many(texts[at:at + 50]) == whole[at:at + 50]
    other = tb.Encoder(tokenizer("byte_bpe_50k.json"))
    assert not other.separable
    assert other.many(["a  b, c"]) == [np.array(other.tok.encode("a  b, c").ids, "<u4").tobytes()]
