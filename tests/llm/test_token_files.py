import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from eventloom.llm import rank_code, token_files  # noqa: E402
from eventloom.llm.queries import QUERIES, word_tokenizer  # noqa: E402
from eventloom.llm.words import buffer_of  # noqa: E402


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(word_tokenizer())


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_code_round_trip(n):
    rng = np.random.default_rng(n)
    values = (2 ** rng.uniform(0, 32, n)).astype(np.uint32)
    control, data = rank_code.encode(values)
    assert len(control) == -(-n // 4)
    assert (rank_code.decode(control, data, n) == values).all()


def test_code_edges():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    control, data = rank_code.encode(values)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert (rank_code.decode(control, data, 8) == values).all()
    with pytest.raises(ValueError):
        rank_code.decode(control, data[:-1], 8)


def test_frequent_ids_get_small_ranks():
    table, ranks = rank_code.ranked(np.array([7, 9, 9, 3, 9, 3]))
    assert table.tolist() == [9, 3, 7]
    assert ranks.tolist() == [2, 0, 0, 1, 0, 1]


def test_same_ids_as_the_library(plain, monkeypatch):
    rng = random.Random(3)
    letters = [*"aAbZ'sStTrReEvV'’ .,\n\t\r\x0b\x0c\x1c\x85  é̸́É…1２٣!<|>ſİıßΣς‍　한漢🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "I'LL"]
    words = token_files.WordIds(word_tokenizer())
    monkeypatch.setattr(token_files, "KEPT_WORDS", 500)  # forgets now and then
    for _ in range(60):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(20)]
        ids, splits = words.encode(*buffer_of(pa.array(texts)))
        for k, text in enumerate(texts):
            assert ids[splits[k] : splits[k + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_another_tokenizer_gives_its_own_ids(name, spark, odd_docs):
    path = public_tokenizers.path(name)
    library, words = Tokenizer.from_file(path), token_files.WordIds(path)
    assert words.by_words == (name == "word_bpe_49k.json")
    texts = ["Two words", " two  Words ", "", "x1-y2 don't", "the the THE", "Été 漢字🙂 <|endoftext|>"]
    ids, splits = words.encode(*buffer_of(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, splits[1:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = {(r["doc_id"], r["n_tokens"]) for r in token_files.encoded(odd_docs, path).collect()}
    want = {(r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in odd_docs.collect()}
    assert got == want


def test_block_round_trip():
    ids = np.array([5, 5, 70_000, 2, 2, 5, 2], np.uint32)
    raw = token_files.block_bytes([3, None], ids, np.array([4, 3])) * 2
    blocks = list(token_files.read_blocks(io.BytesIO(raw)))
    assert len(blocks) == 2
    docs, lengths, back = blocks[1]
    assert docs == [3, None] and lengths.tolist() == [4, 3] and back.tolist() == ids.tolist()
    with pytest.raises(ValueError):
        list(token_files.read_blocks(io.BytesIO(b"nonsense" + raw)))


def expected(plain, rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_odd_rows(spark, plain, odd_docs, monkeypatch):
    got = [tuple(r) for r in token_files.encoded(odd_docs, word_tokenizer(), file_bytes=200_000).collect()]
    want = expected(plain, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert sorted(got, key=lambda r: r[1]) == want


def test_no_rows(spark, no_docs):
    got = token_files.encoded(no_docs, word_tokenizer())
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op1_token_files"](spark, sf).collect()), key=lambda r: r[1])
    assert got == expected(plain, rows)


def test_words_kept_or_not(spark, odd_docs):
    docs = odd_docs.unionByName(odd_docs.withColumn("doc_id", odd_docs["doc_id"] + 100))
    rows = [sorted(token_files.encoded(docs, word_tokenizer(), keep_words=keep, file_bytes=64).toPandas().astype(str).values.tolist()) for keep in (True, False)]
    assert rows[0] == rows[1]
