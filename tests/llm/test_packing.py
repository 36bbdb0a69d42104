"""Packing against the whole tokenizer and against what a sequence has to be."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterline.llm import packing
from meterline.llm.queries import QUERIES, WORD_PIECES
from tests.conftest import SMALL
from tests.llm.test_operators import empty, odd  # noqa: F401

with open(public_tokenizers.path(WORD_PIECES), encoding="utf-8") as _file:
    DEFINITION = _file.read()
WHOLE = Tokenizer.from_str(DEFINITION)

letters = st.text(
    st.sampled_from(list("aBz é́ÉßẞİΣσς'’s.,!?-0٣½中かな한가\t\n\r\x00  ḴhH🎉")), max_size=60
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(letters, st.text(max_size=30)), max_size=5))
@example(["it's <|endoftext|> x<|startoftext|>y", "", "  \n\n "])
@example(["A word, and another: words! Word. (word) H̱ ẖ"])
def test_words_one_by_one_give_the_ids_of_whole_texts(texts):
    ids, counts = packing._encoder(DEFINITION)(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])][: len(texts)] == [
        WHOLE.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encode = packing.Encoder(DEFINITION)
    for text in ("one two three four five", "one six", "one, two."):
        assert encode([text])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 20), st.integers(1, 300)), max_size=60), st.sampled_from([1, 16, 64]))
def test_every_token_is_placed_once_without_padding(lengths, capacity):
    laid = packing.lay_out(np.array(lengths, np.int64), capacity)
    by_doc, by_sequence = {}, {}
    for doc, start, n, sequence, offset in laid:
        assert n > 0
        by_doc.setdefault(doc, []).append((start, n))
        by_sequence.setdefault(sequence, []).append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_doc[doc]):
            assert start == at
            at += size
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= capacity and at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_costs_are_balanced_and_a_sequence_causes_one_cut_at_most():
    lengths = np.random.default_rng(5).integers(1, 1500, 4000)
    laid = packing.lay_out(lengths)
    cost, size = {}, {}
    for _, _, n, sequence, _ in laid:
        cost[sequence] = cost.get(sequence, 0) + packing.LINEAR * n + n * n
        size[sequence] = size.get(sequence, 0) + n
    full = [cost[s] for s in cost if size[s] == packing.CAPACITY]
    assert max(full) / min(full) < 1.1 and len(laid) - len(lengths) < len(cost)


def check(spark, docs, got):
    """The pieces of each row, which its id names, hold the row's tokens."""
    want = {}
    for r in docs.collect():
        ids = WHOLE.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4"))
    assert sum(r.length for r in got) == sum(len(x) for xs in want.values() for x in xs)
    for r in got:
        pieces = [x[r.start : r.start + r.length] for x in want[r.doc_id] if len(x) == r.doc_tokens]
        assert any(bytes(r.ids) == x.tobytes() for x in pieces) and len(r.ids) == 4 * r.length
    totals = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == totals.get(r.sequence_id, 0)
        totals[r.sequence_id] = r.offset + r.length
    assert all(n <= 64 and n & (n - 1) == 0 for n in totals.values())


def test_odd_rows(spark, odd, empty):  # noqa: F811
    got = packing.pack(odd, DEFINITION, 2, capacity=64, group=500).collect()
    check(spark, odd, got)
    assert sum(r.doc_id == 3 for r in got) == 1 and [r.length for r in got if r.doc_id == 3] == [1]
    assert sum(r.start == 0 for r in got) == odd.count()
    assert packing.pack(empty, DEFINITION, 2).isEmpty()
    with pytest.raises(ValueError):
        packing.pack(odd, DEFINITION, 2, capacity=100)


def test_ids_of_other_types(spark):
    for kind, value in (("string", "a"), ("smallint", 7), ("decimal(20,0)", 2**60), ("bigint", 2**60 + 1)):
        docs = spark.createDataFrame([(str(value), "some words"), (None, "more")], "doc_id string, text string")
        got = packing.pack(docs.selectExpr(f"cast(doc_id as {kind}) doc_id", "text"), DEFINITION, 2)
        assert got.schema["doc_id"].dataType.simpleString() == kind and value in {r.doc_id for r in got.collect()}


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()
    want = {r.doc_id: np.array(WHOLE.encode(r.text, add_special_tokens=False).ids + [2], "<u4") for r in docs}
    for r in QUERIES["op12_cost_packing"](spark, SMALL).collect():
        if r.doc_id in want:
            ids = want[r.doc_id]
            assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes()))
