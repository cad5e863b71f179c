import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quietwire.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "İstanbul IJ ﬁne Ǆ", "<|endoftext|> <|ENDOFTEXT|>x", "it's O'Neil's a'd", "áb ñ é́", "東京 ٣٤ ½", "ΑΣ Σ. \xa0x y\x1cz\x85w",
    "foo...bar,,, #1%", "ῼ ß. ẞ", "", " \t", "\x1c", "a\x1d b", "Wort.", "Été!!", "x" * 300,
]


def ids_of(text):
    tokenizer = Tokenizer.from_file(PATH)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer():
    code = packing.encoder(PATH)
    for text in ODD:
        assert np.frombuffer(code.encode(text), "<u4").tolist() == ids_of(text)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(text):
    assert np.frombuffer(packing.encoder(PATH).encode(text), "<u4").tolist() == ids_of(text)[:-1]


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_round_trip(spark):
    texts = [*ODD, None, "alpha beta " * 3000, "gamma " * 4095, "Hello there. " * 40, "Hello there. " * 40]
    docs = spark.createDataFrame([(i % 16, t, 5, "l") for i, t in enumerate(texts)], "doc_id bigint, text string, length int, offset string")
    rows = packing.pack_documents(docs.repartition(3), PATH).collect()
    want = []
    for i, t in enumerate(texts):
        ids = ids_of(t)
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((i % 16, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    assert check_packing(rows, 4096) == -(-sum(w[3] for w in want) // 4096)
    assert packing.pack_documents(docs.where("false"), PATH).count() == 0


@pytest.mark.parametrize("counts,capacity,best", [
    ({7: 3, 3: 3}, 10, 3), ({5: 2, 4: 2, 1: 2}, 10, 2), ({4: 1, 3: 1, 2: 1, 1: 1}, 10, 1), ({10: 4}, 10, 4), ({6: 5}, 10, 5),
    ({1: 1000}, 10, 100), ({3: 10}, 10, 4), ({}, 10, 0),
])
def test_plans(counts, capacity, best):
    made = packing.plan(counts, capacity)
    used = {}
    for times, inside in made:
        assert sum(length * n for length, n in inside) <= capacity
        for length, n in inside:
            used[length] = used.get(length, 0) + times * n
    assert used == counts
    assert sum(times for times, _ in made) == best


def test_large_plan_is_close_to_the_bound():
    lengths = np.clip(np.random.default_rng(3).exponential(700, 50_000).astype(int) + 1, 1, 4096)
    values, counts = np.unique(lengths, return_counts=True)
    made = packing.plan(dict(zip(values.tolist(), counts.tolist())))
    assert sum(t for t, _ in made) <= 1.001 * lengths.sum() / 4096 + 1
    assert len(made) <= 2 * 4096


def test_many_pieces_of_one_length(spark):
    parts = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 700L, 596L) as length", "1L as ids_crc32")
    rows = packing.pack(parts).collect()
    assert len(rows) == 5000
    assert check_packing(rows, 4096) == -(-5000 // 6)  # seven of either length never fit
