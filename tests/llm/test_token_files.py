import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm import token_files
from rollcall.llm.elias_fano import EliasFano, encode
from rollcall.llm.token_files import ByteTokenizer, Shard, digest, read, shard_bytes, write

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u180e\u2003\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [5, 5, 9, 9, 2**40], list(range(1000)), [0] * 700 + [2**63 + 5] * 700, [2**64 - 1]])
def test_elias_fano_holds(values):
    own = EliasFano(encode(np.array(values, np.uint64)))
    assert own.all().tolist() == values and len(own) == len(values)
    assert own.size == len(encode(np.array(values, np.uint64)))
    for v in {*values[:20], 3}:
        assert own.rank(v) == sum(x < v for x in values)


def test_elias_fano_random_and_small():
    r = random.Random(3)
    for _ in range(60):
        top = r.choice([3, 900, 10**6, 2**50])
        values = sorted(r.randrange(top) for _ in range(r.randrange(1, 3000)))
        data = encode(np.array(values, np.uint64))
        own = EliasFano(data)
        at = [r.randrange(len(values)) for _ in range(50)]
        assert own.select(np.array(at)).tolist() == [values[i] for i in at]
        bits = 2 + math.ceil(math.log2(max(top / len(values), 1)))
        assert 8 * len(data) <= len(values) * (bits + 32 / 256) + 8 * 64


def texts():
    r = random.Random(5)
    parts = ["the", "Thé", "don't", "'s", "it's'll", "x<|endoftext|>y", "<|endoftext|>", "<|endoftex", "e.g.:", "12,5", "3rd", "!?", "中文", "😀", "é", "á", "_", "--", "ſ", "x" * 70, "'", "’s", "½", "Ⅷ"]
    out = [None, "", " ", "\n", "a", " a", "a ", "\n\na", "a\n \nb  "]
    for _ in range(300):
        out.append("".join(r.choice(parts) + r.choice(["", " ", " ", ". ", r.choice(SPACES) * r.choice([1, 2])]) for _ in range(r.choice([2, 9, 60]))))
    return [*out, "word " * 3000 + "\n" + "ab" * 4000]


def want(own):
    public = Tokenizer.from_file(PATH)
    return [[*e.ids, 0] for e in public.encode_batch([t or "" for t in own], add_special_tokens=False)]


@pytest.mark.parametrize("step", [1 << 20, 40])
def test_ids_are_the_librarys(monkeypatch, step):
    monkeypatch.setattr(token_files, "STEP_CHARS", step)
    monkeypatch.setattr(token_files, "REMEMBERED_PIECES", 50)
    own, tokenizer = texts(), ByteTokenizer(PATH)
    got = [np.frombuffer(x, "<u2").tolist() for t in (own[:100], own[100:], own) for x in tokenizer.ids([t or "" for t in t])]
    assert got == [x[:-1] for x in want(own)] * 2


def test_shard_by_rank_and_name():
    ids = [[1, 2, 3], [4], [5, 6], [7, 7, 7, 7]]
    own = Shard(shard_bytes(3, 1, 2, [None, -9, -9, 2**40], [np.array(x, "<u2").tobytes() for x in ids]) + b"\n")
    assert (own.part, own.number, own.n_docs, own.n_ids) == (3, 1, 4, 10)
    assert [own.document(i).tolist() for i in range(4)] == ids
    assert list(own.find(-9)) == [1, 2] and list(own.find(2**40)) == [3] and list(own.find(5)) == [] and list(own.find(-10)) == []
    assert own.doc_ids() == [None, -9, -9, 2**40]
    with pytest.raises(ValueError):
        Shard(b"x" * 80)


def test_digest_and_files(spark, tmp_path):
    """Repeated doc_ids and rows, null ids, clashing extra columns; shards of one document and of many."""
    own = texts()
    names = [None if i % 41 == 3 else i // 2 - 40 for i in range(len(own))]
    rows = [(n, t, 1, 2) for n, t in zip(names, own, strict=True)] + [(77, "same row", 1, 2)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, range int").repartition(3)
    ids = want([r[1] for r in rows])
    folder = str(tmp_path / "files")
    write(docs, PATH, folder, shard_ids=700)
    got = read(spark, folder, with_ids=True).collect()
    assert len({(r.range, r.shard) for r in got}) > 8
    assert sorted(((r.doc_id is not None, r.doc_id or 0, list(r.ids))) for r in got) == sorted((n is not None, n or 0, x) for (n, *_), x in zip(rows, ids, strict=True))
    in_order = [r.doc_id for r in sorted(got, key=lambda r: (r.range, r.shard, r.at))]
    assert in_order == sorted(in_order, key=lambda n: (n is not None, n or 0))
    out = sorted(digest(docs, PATH).collect(), key=lambda r: r.start)
    assert [r.start for r in out] == np.cumsum([0, *(r.n_tokens for r in out)])[:-1].tolist()
    assert [r.doc_id for r in out] == in_order
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((r.doc_id or -999, r.n_tokens, r.ids_crc32) for r in out) == sorted((n or -999, len(x), crc(x)) for (n, *_), x in zip(rows, ids, strict=True))


def test_empty(spark):
    assert digest(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
