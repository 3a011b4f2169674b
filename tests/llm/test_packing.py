import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Public

from rollcall.llm import _text, packing
from rollcall.llm.packing import Packer, Tokenizer, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    r = random.Random(4)
    words = ["the", "Thntion", "don't", "éÈü", "x<|endoftext|>y", "<|EndOfText|>", "<|endoftext|>", "End.", "e.g.:", "it'S!", "É.!?", "a.'s", "b.…", "a b", " ", "ΣΑΣ", "12,5", "café", "😀", "\x1c", "q" * 3000, "ß"]
    out = [None, "", " \n", "á", " ́x"]
    out += [r.choice([" ", "\n", "\t "]).join(r.choice(words[:-2]) for _ in range(r.choice([3, 40, 900]))) for _ in range(60)]
    return [*out, words[-2], " ".join(r.choice(words) for _ in range(9000))]


def brute(own):
    public = Public.from_file(PATH)
    return {i: [*public.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(own)}


@pytest.mark.parametrize(("capacity", "limit"), [(4096, 1024), (64, 8)])
def test_round_trip(spark, capacity, limit, monkeypatch):
    monkeypatch.setattr(packing, "OPEN_LIMIT", limit)
    own = texts()
    want = brute(own)
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(own)], "doc_id long, text string, offset long").repartition(2)
    rows = pack(docs, PATH, capacity, with_ids=True).collect()
    got, sequences = defaultdict(dict), defaultdict(dict)
    for r in rows:
        assert len(r.ids) == r.length > 0 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id][r.start] = r.ids
        sequences[r.sequence_id][r.offset] = r.length
    for i, ids in want.items():
        assert [x for s in sorted(got[i]) for x in got[i][s]] == ids
    fills = []
    for parts in sequences.values():
        at = 0
        for o in sorted(parts):
            assert o == at
            at += parts[o]
        assert at <= capacity
        fills.append(at)
    assert sum(f < capacity for f in fills) <= 2


def test_level_is_the_one_of_least_sum_of_squares():
    r = random.Random(9)
    packer = Packer(32, lambda pieces: None)
    for _ in range(500):
        s = r.randint(1, 31)
        before = packer.levels.copy()
        options = []
        for h in range(33 - s):
            if h == 0 or before[h]:
                after = before.copy()
                after[h] -= h > 0
                after[h + s] += h + s < 32
                options.append((int((after[1:] ** 2).sum()), h))
        best = min(o[0] for o in options)
        assert packer.level_for(s) == max(h for v, h in options if v == best)
        packer._place((0, 0, np.zeros(s, np.uint32), s))


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_PIECES", 5)
    own = texts()
    tokenizer = Tokenizer(PATH)
    flat = []
    for t in own:
        ids, bounds = tokenizer.ids(pa.array([t or ""]))
        assert list(bounds) == [0, len(ids)]
        flat.append([*ids.tolist(), 2])
    assert flat == list(brute(own).values())


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_thue_morse_words_have_their_own_ids():
    """Words that differ and yet collide under any hash that is a polynomial modulo 2^64; and all words one hash."""
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    own = [f"x{a}x x{b}x", f"x{b}x", "abcdefgh", "abcdefgi", "abcdefgh0123", "abcdefgh0124", "a", "a\0"]
    flat, bounds = Tokenizer(PATH).ids(pa.array(own))
    assert [[*flat[i:j].tolist(), 2] for i, j in zip(bounds[:-1], bounds[1:], strict=True)] == list(brute(own).values())
    assert _text.Words(pa.array([a])).hashes(True) != _text.Words(pa.array([b])).hashes(True)


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(_text, "mix", lambda h: h & np.uint64(1))
    own = ["one two three four two one", "four three five six", "six five one"]
    tokenizer = Tokenizer(PATH)
    for t in own:
        flat, _ = tokenizer.ids(pa.array([t]))
        assert [*flat.tolist(), 2] == brute([t])[0]


def test_very_long_text(spark):
    """A text of 5 MB in many sequences, beside short ones and repeated rows, with clashing columns."""
    own = ["The same few words, again and again. " * 140_000, "short", "short"]
    docs = spark.createDataFrame([(i // 2, t, 1, 2) for i, t in enumerate(own)], "doc_id long, text string, length int, sequence_id int")
    rows = pack(docs, PATH).collect()
    sizes = [len(x) for x in brute(own).values()]
    assert sum(r.length for r in rows) == sum(sizes) and sorted(r.doc_tokens for r in rows if r.start == 0) == sorted(sizes)
    assert max(r.length for r in rows) == 4096
