"""Exact top-k by integer inner product over a bit-sliced index.

Rows fall into blocks. A block keeps, for every dimension, bitmaps over its rows: one per bit of the
quantised attribute, quantised once more by leaving out DROP_BITS low bits. A query's scores come as
bitmaps too: for every signed binary digit of a query weight the attribute's slices are added, shifted, by
full adders on whole bitmaps. The k-th best is found from the most significant slice downward. What
the left-out bits can add is bounded for each query; rows within that bound of the k-th best are
the boundary, and their scores are computed from the full integers.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievetally.llm.common import spread
from sievetally.session import cut_lineage

BLOCK_ROWS = 8192
QUERY_ROWS = 256
DROP_BITS = 2
LONG = 2**63


def quantise(vectors: list, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, in rows side by side; shorter ones end in zeros.

    In the narrowest type that holds them and their differences: integers, or doubles, which are whole numbers here, beyond 64 bits.
    """
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(scale * np.asarray(v, np.float64))
    if not np.isfinite(out).all():
        raise OverflowError("a component times the scale is beyond a double")
    most = np.abs(out).max(initial=0)
    kind = next((t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max), np.int64 if most < LONG // 4 else np.float64)
    return out.astype(kind)


def integers(values: np.ndarray) -> np.ndarray:
    """Quantised values as 64-bit integers, or as Python's where they were doubles."""
    if values.dtype != np.float64:
        return values.astype(np.int64)
    out = np.empty(values.shape, object)
    out.flat = [int(x) for x in values.ravel().tolist()]
    return out


def signed_digits(weight: int) -> list[tuple[int, int]]:
    """(shift, sign) of the non-adjacent form of weight: the fewest signed powers of two."""
    digits, shift = [], 0
    while weight:
        if weight & 1:
            sign = 2 - (weight & 3)
            digits.append((shift, sign))
            weight -= sign
        weight >>= 1
        shift += 1
    return digits


def add_slices(columns: dict[int, list[np.ndarray]], words: int) -> np.ndarray:
    """Binary sums of bitmaps, one sum per row: columns[s] holds (n, words) arrays of weight 2**s; the result has one bitmap per bit, lowest first."""
    out, place = [], 0
    last = max(columns, default=-1)
    while place <= last:
        stack = columns.pop(place, [])
        bits = np.concatenate(stack) if stack else np.zeros((0, words), np.uint64)
        while len(bits) > 1:
            whole = len(bits) // 3 * 3
            if whole:
                a, b, c = bits[0:whole:3], bits[1:whole:3], bits[2:whole:3]
                half = a ^ b
                columns.setdefault(place + 1, []).append(a & b | half & c)
                bits = np.concatenate([half ^ c, bits[whole:]])
            else:
                columns.setdefault(place + 1, []).append((bits[0] & bits[1])[None])
                bits = (bits[0] ^ bits[1])[None]
            last = max(last, place + 1)
        out.append(bits[0] if len(bits) else np.zeros(words, np.uint64))
        place += 1
    return np.array(out) if out else np.zeros((0, words), np.uint64)


def _bitmap(bits: np.ndarray, words: int) -> np.ndarray:
    padded = np.zeros(words * 64, np.uint8)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_largest(sums: np.ndarray, rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among rows (a bitmap with at least k bits), from the most significant slice downward."""
    value, sure, open_ = 0, 0, rows
    for place in range(len(sums) - 1, -1, -1):
        high = open_ & sums[place]
        n = _count(high)
        if sure + n >= k:
            value |= 1 << place
            open_ = high
        else:
            sure += n
            open_ = open_ & ~sums[place]
    return value


def at_least(sums: np.ndarray, rows: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows whose sum is value or more."""
    if value <= 0:
        return rows
    if value >> len(sums):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for place in range(len(sums) - 1, -1, -1):
        if value >> place & 1:
            equal = equal & sums[place]
        else:
            above = above | equal & sums[place]
            equal = equal & ~sums[place]
    return above | equal


class SlicedBlock:
    """The slices of one block: attribute d has slices at first[d]..first[d+1], of value - its least, lowest bit first."""

    def __init__(self, values: np.ndarray, first: np.ndarray, slices: np.ndarray, drop_bits: int):
        self.values, self.first, self.slices, self.drop_bits = values, first, slices, drop_bits
        self.words = -(-len(values) // 64)
        self.rows = _bitmap(np.ones(len(values), np.int64), self.words)
        self.most = int(max(-int(values.min(initial=0)), int(values.max(initial=0))))

    @classmethod
    def build(cls, values: np.ndarray, drop_bits: int) -> SlicedBlock:
        words, coarse = -(-len(values) // 64), integers(values) >> drop_bits
        coarse = coarse - coarse.min(axis=0)
        widths = [int(x).bit_length() for x in coarse.max(axis=0)]
        flat = [_bitmap((coarse[:, d] >> bit & 1).astype(np.int64), words) for d, width in enumerate(widths) for bit in range(width)]
        first = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
        return cls(values, first, np.array(flat) if flat else np.zeros((0, words), np.uint64), drop_bits)

    def packed(self) -> dict:
        return {"vecs": self.values.tobytes(), "kind": self.values.dtype.str, "width": self.values.shape[1], "first": self.first.tobytes(), "slices": self.slices.tobytes()}

    @classmethod
    def unpacked(cls, n: int, drop_bits: int, vecs: bytes, kind: str, width: int, first: bytes, slices: bytes) -> SlicedBlock:
        values = np.frombuffer(vecs, np.dtype(kind)).reshape(n, width)
        return cls(values, np.frombuffer(first, np.int32), np.frombuffer(slices, np.uint64).reshape(-1, -(-n // 64)), drop_bits)

    def scores(self, rows: np.ndarray, weights: list[int]) -> list[int]:
        """Inner products of some rows: in 64 bits where no sum can exceed them, else by Python's integers."""
        values = integers(self.values[rows, : len(weights)])
        if max(map(abs, weights), default=0) * self.most * len(weights) < LONG:
            return (values @ np.array(weights, np.int64)).tolist()
        return [sum(v * w for v, w in zip(row, weights, strict=True)) for row in values.tolist()]

    def sums(self, weights: list[int]) -> np.ndarray:
        """Slices of each row's weighted sum of attributes, less a number that is the same for all rows.

        A negative digit adds the complement of a slice, which is one less the slice.
        """
        plus: dict[int, list[int]] = defaultdict(list)
        minus: dict[int, list[int]] = defaultdict(list)
        for d, weight in enumerate(weights):
            for shift, sign in signed_digits(weight):
                to = plus if sign > 0 else minus
                for bit in range(self.first[d + 1] - self.first[d]):
                    to[shift + bit].append(self.first[d] + bit)
        columns: dict[int, list[np.ndarray]] = {}
        for place in plus.keys() | minus.keys():
            columns[place] = [self.slices[plus[place]], ~self.slices[minus[place]]]
        return add_slices(columns, self.words)

    def top(self, weights: list[int], k: int, but: int | None, order: np.ndarray) -> tuple[list[int], list[int]]:
        """(rows, scores) of the k best rows, `but` left out, ties by order."""
        weights = weights[: self.values.shape[1]]
        rows = self.rows
        if but is not None:
            rows = rows.copy()
            rows[but // 64] &= ~np.uint64(1 << but % 64)
        k = min(k, _count(rows))
        if not k:
            return [], []
        sums = self.sums(weights)
        # The left-out bits of an attribute are 0 to 2**drop_bits - 1: a score is the coarse one and something in a range as wide as this.
        reach = (2**self.drop_bits - 1) * sum(map(abs, weights))
        cut = kth_largest(sums, rows, k) - (reach >> self.drop_bits)
        kept = np.flatnonzero(np.unpackbits(at_least(sums, rows, cut).view(np.uint8), bitorder="little"))
        scores = self.scores(kept, weights)
        best = sorted(range(len(kept)), key=lambda i: (-scores[i], order[kept[i]]))[:k]
        return [int(kept[i]) for i in best], [scores[i] for i in best]


def usable(vector: str = "vec") -> F.Column:
    """Whether a vector is not null and all its components are finite."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def top_k(vectors: DataFrame, queries: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, drop_bits: int = DROP_BITS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for every row that `queries`, SQL over vec_id, selects.

    Ties go to the smaller vec_id, a null one last. A row is a query by itself and a candidate for all others,
    also where ids or vectors repeat: a copy is another row. Null vectors and those with null or
    non-finite components take no part; shorter vectors count as ending in zeros. With fewer than k
    other rows all are returned; an empty table gives no rows.

    Scores are exact for all finite components; one among the k best that is beyond a long is an error.

    Every query meets every block: blocks and query groups are joined on numbers of both, so that
    a task holds one block and one group of queries at a time. A block's slices are built once, and they travel with the
    quantised values in their narrowest type.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec")).where(usable())
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("query", F.coalesce(F.expr(queries), F.lit(False))), "vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    n_blocks, n_groups = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    kind = "vec_ids array<long>, row_ids array<long>, vecs binary, kind string, width int"

    def packed(part: pa.Table, sliced: bool) -> pa.Table:
        part = part.sort_by("row")
        values = quantise(part.column("vec").to_pylist(), scale)
        row = {"number": part.column("number")[0].as_py(), "vec_ids": part.column("vec_id").to_pylist(), "row_ids": part.column("row").to_pylist()}
        row |= SlicedBlock.build(values, drop_bits).packed() if sliced else {"vecs": values.tobytes(), "kind": values.dtype.str, "width": values.shape[1]}
        types = {"number": pa.int32(), "vec_ids": pa.list_(pa.int64()), "row_ids": pa.list_(pa.int64()), "vecs": pa.binary(), "kind": pa.string(), "width": pa.int32(), "first": pa.binary(), "slices": pa.binary()}
        return pa.table({c: pa.array([v], types[c]) for c, v in row.items()})

    def grouped(part: DataFrame, n: int, sliced: bool) -> DataFrame:
        more = ", first binary, slices binary" if sliced else ""
        return part.withColumn("number", spread(F.col("row"), n)).groupBy("number").applyInArrow(lambda t: packed(t, sliced), f"number int, {kind}{more}")

    blocks = cut_lineage(grouped(rows, n_blocks, True), "sliced_blocks")
    blocks = blocks.withColumnRenamed("number", "block").withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    groups = grouped(rows.where("query"), n_groups, False)
    groups = groups.selectExpr("number AS grp", "vec_ids AS q_vec_ids", "row_ids AS q_row_ids", "vecs AS q_vecs", "kind AS q_kind", "width AS q_width")
    groups = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    names = ["q_row", "query_id", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                x = batch.slice(at, 1).to_pylist()[0]
                ids = x["vec_ids"]
                order = np.array([LONG - 1 if i is None else i for i in ids], np.int64)
                own = {row: i for i, row in enumerate(x["row_ids"])}
                block = SlicedBlock.unpacked(len(ids), drop_bits, *(x[c] for c in ("vecs", "kind", "width", "first", "slices")))
                weights = integers(np.frombuffer(x["q_vecs"], np.dtype(x["q_kind"])).reshape(len(x["q_vec_ids"]), x["q_width"])).tolist()
                found: list[tuple] = []
                for q_row, q_id, w in zip(x["q_row_ids"], x["q_vec_ids"], weights, strict=True):
                    best, scores = block.top(w, k, own.get(q_row), order)
                    if any(abs(s) >= 10**38 for s in scores):
                        raise OverflowError(f"a score of query {q_id} is beyond 38 digits")
                    found += [(q_row, q_id, ids[i], s) for i, s in zip(best, scores, strict=True)]
                columns = list(zip(*found, strict=True)) or [()] * 4
                types = [pa.int64()] * 3 + [pa.decimal128(38)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    pairs = blocks.join(groups, ["block", "grp"])
    # The best of a block may be beyond a long without being among the best of all.
    found = pairs.mapInArrow(search, "q_row long, query_id long, vec_id long, score decimal(38,0)")
    best = Window.partitionBy("q_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))
