import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievetally.llm.packing import best_fit, pack, pack_documents, piece_lengths, sequences
from sievetally.llm.vocabulary import json_encoder

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    JSON = file.read()
KNOWN = Tokenizer.from_str(JSON)
ENCODE = json_encoder(JSON, public_tokenizers.PATTERN)


def check_bins(items, placed, capacity):
    """Every item once, sequences without gaps from 0 and within capacity; returns the number of sequences."""
    length = dict(items)
    assert sorted(i for i, _, _ in placed) == sorted(length)
    bins = {}
    for item, sequence, offset in placed:
        bins.setdefault(sequence, []).append((offset, length[item]))
    for parts in bins.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    return len(bins)


@given(st.integers(1, 5000), st.integers(1, 50))
def test_pieces(total, capacity):
    parts = piece_lengths(total, capacity)
    assert sum(parts) == total and all(0 < p <= capacity for p in parts)
    assert all(p == capacity for p in parts[1:])
    assert len(parts) == 1 or total > capacity


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_is_the_plain_one(lengths):
    ids = np.arange(len(lengths)) * 7 + 3
    bins, offsets = best_fit(ids, np.array(lengths, np.int64), 64)
    n = check_bins(list(zip(ids.tolist(), lengths, strict=True)), list(zip(ids.tolist(), bins.tolist(), offsets.tolist(), strict=True)), 64)
    rooms = []
    for x in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= x]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - x)
        else:
            rooms.append(64 - x)
    assert n == len(rooms)


@pytest.mark.parametrize("group_items", [10, 100, 10_000])
def test_rounds_come_close_to_one_group(spark, group_items):
    rng = np.random.default_rng(group_items)
    items = [(i, int(x)) for i, x in enumerate(rng.integers(1, 400, 1000))]
    df = spark.createDataFrame(items, "item long, length long")
    n = check_bins(items, [tuple(r) for r in pack(df, 1024, group_items).collect()], 1024)
    least = -(-sum(x for _, x in items) // 1024)
    assert n <= least * (1.03 if group_items > 10 else 1.1) + 1


def test_large_items_end_the_rounds(spark):
    items = [(i, 600 + i % 300) for i in range(300)]
    df = spark.createDataFrame(items, "item long, length long")
    assert check_bins(items, [tuple(r) for r in pack(df, 1024, 20).collect()], 1024) == 300


def test_documents_and_their_sequences(spark, edge_docs):
    rows = pack_documents(edge_docs, JSON, public_tokenizers.PATTERN, capacity=256, with_ids=True)
    got = rows.collect()
    want = []
    for r in edge_docs.collect():
        ids = [*KNOWN.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        start = 0
        for piece, n in enumerate(piece_lengths(len(ids), 256)):
            packed = np.array(ids[start : start + n], "<u4").tobytes()
            want.append((r["doc_id"], piece, start, n, zlib.crc32(packed)))
            start += n
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in sequences(rows).collect()}
    for r in got:
        assert whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert sum(map(len, whole.values())) == 4 * sum(r["length"] for r in got)


def test_empty_table(no_docs):
    assert pack_documents(no_docs, JSON, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_encoder_gives_the_ids_of_the_library(text):
    for x in (text, text + "<|endoftext|>" + text):
        assert ENCODE(x).tolist() == KNOWN.encode(x, add_special_tokens=False).ids


def test_long_runs():
    encode = ENCODE
    for x in ("a" * 25_000, " " * 25_000 + "b", "x y " * 10_000):
        assert encode(x).tolist() == KNOWN.encode(x, add_special_tokens=False).ids


def test_offsets_are_longs(spark):
    df = spark.createDataFrame([(1, 5), (2, 1024)], "item long, length long")
    assert dict(pack(df).dtypes) == {"item": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    assert pack(df.where(F.lit(False))).collect() == []
