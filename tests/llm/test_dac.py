"""Directly addressable codes: random access, and the files against the encoder."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from paddock.llm import bpe, dac


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_every_id_is_addressable(ids):
    segment = dac.Segment(dac.pack(np.array(ids, np.uint32)))
    assert segment.range(0, len(ids)).tolist() == ids
    for i in range(0, len(ids), 7):
        assert segment.get(i) == ids[i]
    for a, b in ((0, 0), (len(ids) // 3, 2 * len(ids) // 3), (len(ids), len(ids))):
        assert segment.range(a, b).tolist() == ids[a:b]


def test_bounds_and_magic():
    segment = dac.Segment(dac.pack(np.array([5], np.uint32)))
    with pytest.raises(IndexError):
        segment.get(1)
    with pytest.raises(ValueError):
        dac.Segment(b"none")


@pytest.mark.parametrize("segment_ids", [3, 1 << 18])
def test_files(spark, docs, odd_texts, monkeypatch, segment_ids):
    monkeypatch.setattr(dac, "SEGMENT_IDS", segment_ids)
    pairs = [(7 * i % 11, t) for i, t in enumerate(odd_texts)] + [(None, "no id"), (4, "twice"), (4, "twice")]
    got = sorted(dac.written_and_read(docs(pairs, clash=True).repartition(3)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in pairs), key=lambda i: (i is not None, i))
    own, start = bpe.WordBpe(bpe.default_path()), 0
    left = [(i, np.append(own.encode(t).astype("<u4"), 1).astype("<u4")) for i, t in pairs]
    for row in got:
        assert row.start == start
        start += row.n_tokens
        fitting = [x for x in left if x[0] == row.doc_id and zlib.crc32(x[1].tobytes()) == row.ids_crc32]
        assert fitting and len(fitting[0][1]) == row.n_tokens
    assert start == sum(len(ids) for _, ids in left)


def test_empty_table(spark, docs):
    assert dac.written_and_read(docs([])).count() == 0


@pytest.mark.parametrize("segment_ids", [5, 1 << 18])
def test_tokens_by_their_place_in_the_corpus(spark, docs, tmp_path, monkeypatch, segment_ids):
    monkeypatch.setattr(dac, "SEGMENT_IDS", segment_ids)
    pairs = [(i, f"word {i} and more " * (i % 5)) for i in range(60)]
    path = str(tmp_path / "segments")
    dac.write_segments(docs(pairs).repartition(4), path)
    own = bpe.WordBpe(bpe.default_path())
    want = [t for _, text in pairs for t in [*own.encode(text).tolist(), dac.END_ID]]
    segments = spark.read.schema(dac.SEGMENTS).parquet(path)
    asked = spark.createDataFrame([(i,) for i in [*range(len(want)), 3, -1, len(want), None]], "position long")
    got = sorted(map(tuple, dac.tokens_at(segments, asked).collect()))
    assert got == list(enumerate(want))


def test_order_of_equal_ids_does_not_depend_on_files(spark, docs):
    pairs = [(i // 4, f"text {i * 37 % 11}") for i in range(40)]
    read = lambda order, n: sorted(map(tuple, dac.written_and_read(docs(order).repartition(n)).collect()))
    assert read(pairs, 1) == read(pairs[::-1], 5)
