"""Best-fit packing of token pieces into sequences by hierarchical residual packing.

Groups of GROUP_ITEMS pieces are packed apart, largest first, each into the fullest sequence with
room. Nearly full sequences are done. Underfull ones are the items of the next round, which packs
the sequences of neighbouring groups together, and so on up a tree of groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally.llm.common import spread
from sievetally.llm.vocabulary import json_encoder
from sievetally.session import cut_lineage

GROUP_ITEMS = 32_768
# A sequence with less free room than this is nearly full.
SLACK = 8


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of one document: uncut up to the capacity, else the remainder first and full pieces after it."""
    if total <= capacity:
        return [total]
    return [total % capacity or capacity, *[capacity] * ((total - 1) // capacity)]


def tokenize(docs: DataFrame, tokenizer_json: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of every document, each ended by end_id.

    tokenizer_json is the text of a byte-level BPE tokenizer file, pattern its pre-token pattern.
    A null text is an empty one and gives the one piece [end_id]; a null id stays null; repeated
    rows give repeated pieces. ids are little-endian unsigned 32-bit integers, null unless with_ids.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])
    vocabulary = docs.sparkSession.sparkContext.broadcast((tokenizer_json, pattern))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = json_encoder(*vocabulary.value)
        for batch in batches:
            rows, places = [], []
            for place, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), end_id).astype("<u4").tobytes()
                start = 0
                for piece, length in enumerate(piece_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((piece, start, length, zlib.crc32(own), own if with_ids else None))
                    places.append(place)
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), *arrays], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def best_fit(ids: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item, largest first, ties by id, each into the fullest bin with room.

    A bin is named by the id of its first item. open_bins holds the open bins by free room; bit r
    of rooms says that some bin has room r.
    """
    order = np.lexsort((ids, -lengths))
    bins, offsets = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for at, item, length in zip(order.tolist(), ids[order].tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            own = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, own = capacity, item
        bins[at], offsets[at] = own, capacity - room
        left = room - length
        if left:
            open_bins[left].append(own)
            rooms |= 1 << left
    return bins, offsets


def _round(items: DataFrame, group: Column, capacity: int) -> DataFrame:
    """(item, bin, at, grp) of items (item, length), packed within each group."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit(rows["item"].to_numpy(np.int64), rows["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"item": rows["item"], "bin": bins, "at": offsets, "length": rows["length"], "grp": rows["grp"]})

    grouped = items.select("item", "length", group.alias("grp")).groupBy("grp")
    return cut_lineage(grouped.applyInPandas(fit, "item long, bin long, at long, length long, grp int"), "packed")


def pack(items: DataFrame, capacity: int = 1024, group_items: int = GROUP_ITEMS, slack: int = SLACK) -> DataFrame:
    """(item, sequence_id, offset) of every row of items (item: unique non-null long, length: 1 to capacity).

    sequence_id is the item at offset 0. Every item is placed in every round, so the tree stops
    where it has nothing more to gain: when one group or no underfull sequence is left, or when the
    underfull ones fill as many groups as before. In the last case they hardly fit together: within
    a group at most one of them is half empty, as two such would have been joined.
    Memory of a task: about group_items items, two numbers each.
    """
    count = items.count()
    groups = max(1, -(-count // group_items))
    level = _round(items, spread(F.col("item"), groups), capacity)
    placed = level.select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    while groups > 1:
        bins = level.groupBy("bin").agg(F.sum("length").alias("length"), F.max("grp").alias("grp")).where(F.col("length") <= capacity - slack)
        smallest = bins.agg(F.min("length")).first()[0]
        if smallest is None:
            break
        bins = cut_lineage(bins.where(F.col("length") <= capacity - smallest).selectExpr("bin AS item", "length", "grp"), "underfull")
        left = bins.count()
        fewer = max(1, -(-left // group_items))
        if left == 0 or fewer >= groups:
            break
        level = _round(bins, F.expr(f"CAST(CAST(grp AS LONG) * {fewer} DIV {groups} AS INT)"), capacity)
        moved = level.where("item != bin").selectExpr("item AS sequence_id", "bin", "at")
        placed = placed.join(moved, "sequence_id", "left").selectExpr("item", "coalesce(bin, sequence_id) AS sequence_id", "offset + coalesce(at, 0L) AS offset")
        groups = fewer
    return placed


def pack_documents(docs: DataFrame, tokenizer_json: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """tokenize() with a place for every piece: sequence_id, and offset in it, without gaps from 0.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for. A full
    piece is a sequence of its own. An empty table gives no rows.
    """
    pieces = tokenize(docs, tokenizer_json, pattern, id_col, text_col, end_id, capacity, with_ids)
    pieces = pieces if with_ids else pieces.drop("ids")
    pieces = cut_lineage(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    columns = [*[c for c in pieces.columns if c != "item"], "sequence_id", "offset"]
    short = pieces.where(F.col("length") < capacity)
    placed = short.join(pack(short.select("item", "length"), capacity), "item")
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", F.col("item")).withColumn("offset", F.lit(0).cast("long"))
    return placed.select(columns).unionByName(full.select(columns))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from the rows of pack_documents(with_ids=True): the packed token sequences themselves.

    A group has at most as many pieces as a sequence has tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
