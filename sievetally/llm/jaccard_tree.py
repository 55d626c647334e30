"""N-gram Jaccard join by signature trees.

Documents are sets of word shingles; two link when their Jaccard similarity reaches the threshold.

1. Equal sets become one class. A sketch of fixed size counts how common shingles are.
2. Sets that reach the threshold share a shingle among the rarest of each: with n shingles, the
   rarest n - ceil(t n) + 1. A twentieth of n more is taken, so that they share a fifteenth of n at least, and sets of like size more. Shared
   rare shingles are counted by pairs where few sets have one. Where more sets have one, each knows how many shingles of that
   kind it has that still more sets have: two sets are joined there only if both have as many as they must share. Pairs that can't share enough are
   dropped; what is left connects sets to clusters, and whatever links lies within a cluster.
3. Each cluster is joined by signature trees: leaves are bitmaps of sets, nodes hold the OR of their
   bitmaps and the range of their sizes. A dual traversal drops pairs of nodes whose largest possible
   overlap is too small. Pairs of leaves that remain make the smaller clusters that may hold links.
4. Only for those the sets themselves are gathered, and the pairs that a traversal leaves are compared exactly.

Large clusters are cut into blocks. Each block is joined in itself first, then one set of every component that this has
made stands for it in further rounds of blocks; what these rounds have not connected is compared across blocks, but never
two blocks of one component. A group of near copies, however large, so takes work in proportion to its size. Where the number of
links is asked for, every pair of blocks is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally.llm.common import as_row, from_row, release_memory, slices, task_count
from sievetally.llm.components import connected_components
from sievetally.llm.near_vectors import roots
from sievetally.llm.terms import mark_table, marked, with_marks
from sievetally.session import cut_lineage

WORDS = 5
# The threshold, as a percentage.
PERCENT = 75
# Counters of the sketch; it is a table of this size however large the corpus.
SKETCH = 1 << 20
SKETCH_CHUNK = 1 << 14
# Sketches added up by one task at a time.
SKETCH_FAN = 256
# Sets that a task remembers, so as to send equal ones once; the mark of all sets to be gathered has so many bits.
MEMO = 500_000
MARK_BITS = 1 << 23
# Bits of the marks of rows that stay, and of those that do not: 4 MB each.
KEPT_BITS = 1 << 25
# Postings that a task gathers before it sends them.
FLUSH = 1 << 18
# Bitmaps, and sets, of one block of a large cluster; for either, shingles at most.
BLOCK_BITMAPS = 1024
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 21
FAN_OUT = 8
# Bitmaps have two to four bits for each shingle, and so many at least.
LEAST_BITS = 64
# Of so many shingles, a set's rarest hold one more than those of which one is shared with every set that links.
SPARE_SHARE = 20
# A rare shingle that more sets share is hot: it is not counted by pairs.
PAIRED_SETS = 16
# Sets that may be joined by a hot shingle are compared by pairs where there are so many at most.
COMPARED_SETS = 512
# Steps of the size class that a set's code carries in its last SIZE_BITS bits.
SIZE_STEP = 1.02
SIZE_BITS = 10

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    state = (state ^ word) * _K1
    return (state ^ (state >> np.uint64(29))) * _K2


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles: runs of `words` words, or the whole sequence where it is shorter.

    Words are what is between blanks (U+0020, U+0009 to U+000D), with A-Z in lower case.
    """
    found = []
    for part in slices(text or ""):
        own = part.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)))
    hashes = np.concatenate(found)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    state = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        state = _mix(state, hashes[i : len(hashes) - size + 1 + i])
    return np.unique(state ^ (state >> np.uint64(32)))


def least_overlap(size: int | np.ndarray, percent: int = PERCENT) -> int | np.ndarray:
    """Fewest shingles that a set of this size shares with any set that it links to."""
    return -(-size * percent // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 |a & b| >= percent |a | b|, for sorted distinct hashes."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def code_of(digest: bytes, size: int) -> int:
    """The first bits of a set's digest and its size class, as a signed long."""
    step = min((1 << SIZE_BITS) - 1, int(np.log(max(size, 1)) / np.log(SIZE_STEP) + 1e-9))
    return (int.from_bytes(digest[:8], "big", signed=True) >> SIZE_BITS << SIZE_BITS) | step


def signature(hashes: np.ndarray) -> bytes:
    """The set's bitmap; its width is the power of two from twice the size."""
    width = max(LEAST_BITS, 2 << (len(hashes) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(hashes % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width: a set's bit is its hash modulo the width."""
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def _describe(hashes: np.ndarray) -> tuple[bytes, int]:
    digest = xxhash.xxh3_128_digest(hashes.tobytes())
    return digest, code_of(digest, len(hashes))


def _size_gap(percent: int) -> int:
    """Largest difference of the size classes of two sets that may link."""
    return int(np.log(100 / percent) / np.log(SIZE_STEP)) + 2


def fewest_shared(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """How many of their rarest shingles sets of codes a and b share at least, if they link.

    Of two sets, take that whose rarest shingles end first in the order. Those of them that the other set has are among its
    rarest too, so at most the n - rarest_count(n) others are shared besides, fewer than t n - n / SPARE_SHARE + 1; a link
    needs t / (1 + t) of both sizes in all. Sizes are known by class, so the least sum and the largest size are taken.
    """
    mask = (1 << SIZE_BITS) - 1
    small, large = np.minimum(a & mask, b & mask).astype(float), np.maximum(a & mask, b & mask).astype(float)
    both = np.ceil((SIZE_STEP**small + SIZE_STEP**large) * (1 - 1e-9) * percent / (100 + percent))
    rest = np.ceil(np.ceil(SIZE_STEP ** (large + 1)) * max(0.0, percent / 100 - 1 / SPARE_SHARE))
    return np.maximum(1, both - rest).astype(np.int64)


def fewest_table(percent: int) -> np.ndarray:
    """fewest_shared() by the smaller size class and the difference of the larger one, for sets that may link."""
    small, apart = np.arange(1 << SIZE_BITS)[:, None], np.arange(_size_gap(percent) + 1)
    return fewest_shared(small, np.minimum(small + apart, (1 << SIZE_BITS) - 1), percent)


def least_shared(percent: int) -> np.ndarray:
    """By size class, the least of fewest_shared() with any set that may link, whether that is larger or smaller."""
    table = fewest_table(percent)
    smaller = [[table[max(0, s - d), min(s, d)] for d in range(table.shape[1])] for s in range(len(table))]
    return np.minimum(table.min(axis=1), np.min(smaller, axis=1))


# --- 1. Sets and the sketch ---
def _sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """A row of each document (doc_id, n, digest, code, bits), and SKETCH_CHUNK counters of each task's sketch in rows of their own."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("code", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            rows = []
            for text in batch.column(1).to_pylist():
                hashes = shingles(text, words)
                if len(hashes):
                    rows.append((len(hashes), *_describe(hashes), signature(hashes)))
                    np.add.at(counts, (hashes % np.uint64(SKETCH)).astype(np.int64), 1)
                else:
                    rows.append((0, None, None, None))
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 4, [pa.int64(), pa.binary(), pa.int64(), pa.binary()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names=schema.names)
        if kind is not None:
            parts = counts.reshape(-1, SKETCH_CHUNK)
            packed = [np.minimum(p, 2**16 - 1).astype("<u2").tobytes() for p in parts]
            none = [pa.nulls(len(parts), t) for t in (kind, pa.int64(), pa.binary(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(len(parts)), pa.int32()), pa.array(packed, pa.binary())], names=schema.names)
        release_memory()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(describe, schema)


def _rarity(sketches: DataFrame) -> bytes:
    """One byte per counter: the logarithm of its sum over all tasks, in quarters of a doubling. The result has SKETCH bytes."""

    def adding(kind: str):
        def add(part: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(SKETCH_CHUNK, np.int64)
            for packed in part["counts"]:
                total += np.frombuffer(packed, kind)
            return pd.DataFrame({"chunk": part["chunk"][:1], "counts": [np.minimum(total, 2**32 - 1).astype("<u4").tobytes()]})

        return add

    some = sketches.select("chunk", "counts", F.spark_partition_id().alias("p"))
    some = some.withColumn("p", (F.col("p") / SKETCH_FAN).cast("int")).groupBy("chunk", "p").applyInPandas(adding("<u2"), "chunk int, counts binary")
    rows = some.groupBy("chunk").applyInPandas(adding("<u4"), "chunk int, counts binary").orderBy("chunk").collect()
    total = np.frombuffer(b"".join(r["counts"] for r in rows), "<u4") if rows else np.zeros(SKETCH, "<u4")
    return np.minimum(255, 4 * np.log2(total.astype(np.float64) + 1)).astype(np.uint8).tobytes()


# --- 2. Clusters ---
def rarest_count(n: int, percent: int = PERCENT) -> int:
    return min(n, n - least_overlap(n, percent) + 1 + n // SPARE_SHARE)


def rarest(hashes: np.ndarray, rarity: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles of which fewest_shared() are shared with every set that links: the rarest by sketch, ties by hash."""
    n = len(hashes)
    if not n:
        return hashes
    level = rarity[(hashes % np.uint64(SKETCH)).astype(np.int64)]
    return hashes[np.argsort(level, kind="stable")[: rarest_count(n, percent)]]


def _postings(docs: DataFrame, text_col: str, words: int, percent: int, rarity, parts: int) -> DataFrame:
    """(part, keys, codes): rarest shingles with the code of their set, packed by the part of the key."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.frombuffer(rarity.value, np.uint8)
        sent: set[int] = set()
        keys, codes, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            key = np.concatenate(keys)
            code = np.repeat(np.array(codes, np.int64), [len(k) for k in keys])
            part = ((key >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
            return pa.RecordBatch.from_arrays(_packed(part, key, code), names=["part", "keys", "codes"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                hashes = shingles(text, words)
                if not len(hashes):
                    continue
                code = _describe(hashes)[1]
                if code in sent:
                    continue
                if len(sent) >= MEMO:
                    sent.clear()
                sent.add(code)
                keys.append(rarest(hashes, common, percent))
                codes.append(code)
                waiting += len(keys[-1])
                if waiting >= FLUSH:
                    yield flush()
                    keys, codes, waiting = [], [], 0
        if waiting:
            yield flush()
        keys.clear()
        release_memory()

    return docs.select(F.col(text_col)).mapInArrow(emit, "part int, keys binary, codes binary")


def _packed(part: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Pieces of the columns by the part of their rows: the part, and each column's values as bytes."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=part[order][:1] - 1)).tolist()
    pieces = [order[a:b] for a, b in zip(cuts, [*cuts, len(order)][1:], strict=True)]
    return [pa.array([int(part[p[0]]) for p in pieces], pa.int32()), *(pa.array([c[p].tobytes() for p in pieces], pa.binary()) for c in columns)]


def _unpacked(part: pa.Table, column: str, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(b"".join(part.column(column).to_pylist()), kind)


def _sorted_by_key(key: np.ndarray, code: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, code, others) in order of key, size and code, each code of a key once; then the number of codes of each row's key."""
    order = np.lexsort((code, code & (1 << SIZE_BITS) - 1, key))
    key, code = key[order], code[order]
    keep = np.concatenate([[True], (key[1:] != key[:-1]) | (code[1:] != code[:-1])])[: len(key)]
    key, code = key[keep], code[keep]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    sets = np.diff(np.append(starts, len(key)))
    return key, code, *(c[order][keep] for c in others), np.repeat(sets, sets)


def _shared_keys(part: pa.Table, gap: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(a, b, shared): pairs of codes with the number of keys that they share, for keys of at most PAIRED_SETS sets;
    (key, code, sets) of the other keys, which are hot.
    """
    key, code, sets = _sorted_by_key(_unpacked(part, "keys", np.uint64), _unpacked(part, "codes"))
    size = code & (1 << SIZE_BITS) - 1
    few = sets <= PAIRED_SETS
    hot = key[~few].view(np.int64), code[~few], sets[~few]
    x = y = np.zeros(0, np.int64)
    pairs = []
    for apart in range(1, min(PAIRED_SETS, len(key))):
        at = np.flatnonzero(few[apart:] & (key[apart:] == key[:-apart]) & (size[apart:] - size[:-apart] <= gap))
        pairs.append((np.minimum(code[at], code[at + apart]), np.maximum(code[at], code[at + apart])))
    if pairs:
        x, y = (np.concatenate(side) for side in zip(*pairs, strict=True))
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])[: len(x)])
    return (x[first], y[first], np.diff(np.append(first, len(x)))), hot


def _hot_ranks(key: np.ndarray, code: np.ndarray, sets: np.ndarray, least: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(code, n) of all codes with hot keys; (key, code, above) of each hot key with the number of a code's keys that are hotter.

    All sets order keys alike, by the sets that have them. Of two sets that share hot keys only, each has all the others of them above the last one,
    so a key with fewer above than any set that links must share besides (least, by size class) is left out.
    """
    order = np.lexsort((key, -sets, code))
    key, code = key[order], code[order]
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[: len(code)])
    n = np.diff(np.append(starts, len(code)))
    above = np.arange(len(code)) - np.repeat(starts, n)
    joins = above + 1 >= least[code & (1 << SIZE_BITS) - 1]
    return (code[starts], n), (key[joins], code[joins], above[joins])


def _hot_links(key: np.ndarray, code: np.ndarray, above: np.ndarray, fewest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): edges that connect the codes that may link by a hot key with the same shared keys above; fewest as fewest_table() has it.

    Keys of more than COMPARED_SETS sets connect all that fit in size.
    """
    key, code, above, sets = _sorted_by_key(key, code, above)
    size, gap = code & (1 << SIZE_BITS) - 1, fewest.shape[1] - 1
    compared = sets <= COMPARED_SETS
    many = np.flatnonzero(~compared[1:] & (key[1:] == key[:-1]) & (size[1:] - size[:-1] <= gap))
    left, right = [code[many]], [code[many + 1]]
    for apart in range(1, int(sets[compared].max(initial=1))):
        at = np.flatnonzero(compared[apart:] & (key[apart:] == key[:-apart]) & (size[apart:] - size[:-apart] <= gap))
        at = at[np.minimum(above[at], above[at + apart]) + 1 >= fewest[size[at], size[at + apart] - size[at]]]
        left.append(code[at])
        right.append(code[at + apart])
    left, right = np.concatenate(left), np.concatenate(right)
    codes, places = np.unique(np.concatenate([left, right]), return_inverse=True)
    root = roots(len(codes), places[: len(left)], places[len(left) :])
    own = np.flatnonzero(root != np.arange(len(codes)))
    return codes[own], codes[root[own]]


def _clusters(docs: DataFrame, text_col: str, words: int, percent: int, rarity) -> DataFrame:
    """(code, cluster) of the sets that may link to a set of another code."""
    gap, table, least, parts = _size_gap(percent), fewest_table(percent), least_shared(percent), task_count(docs.sparkSession)
    pair, hot = ["a", "b", "shared"], ["part", "keys", "codes", "places"]
    kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.binary()] * 3
    schema = "a long, b long, shared long, part int, keys binary, codes binary, places binary"

    def both(rows: list, packed: list) -> pa.Table:
        """Rows of either kind, with nulls in the columns of the other one."""
        n, m = len(rows[0]), len(packed[0])
        columns = [pa.concat_arrays([pa.array(c, t), pa.nulls(m, t)]) for c, t in zip(rows, kinds[:3], strict=True)]
        return pa.table([*columns, *(pa.concat_arrays([pa.nulls(n, t), c]) for c, t in zip(packed, kinds[3:], strict=True))], names=[*pair, *hot])

    def part_of(values: np.ndarray) -> np.ndarray:
        return ((values.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)

    def share(part: pa.Table) -> pa.Table:
        pairs, (key, code, sets) = _shared_keys(part, gap)
        return both(list(pairs), _packed(part_of(code), key, code, sets))

    def rank(part: pa.Table) -> pa.Table:
        (code, n), (key, own, above) = _hot_ranks(*(_unpacked(part, c) for c in hot[1:]), least)
        return both([code, n, n], _packed(part_of(key), key, own, above))

    def join(part: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("a", "b"), map(pa.array, _hot_links(*(_unpacked(part, c) for c in hot[1:]), table)), strict=True)))

    @F.pandas_udf("long")
    def fewest(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(fewest_shared(a.to_numpy(), b.to_numpy(), percent))

    postings = _postings(docs, text_col, words, percent, rarity, parts)
    found = cut_lineage(postings.groupBy("part").applyInArrow(share, schema), "shared_keys")
    ranked = cut_lineage(found.where("part IS NOT NULL").select(*hot).groupBy("part").applyInArrow(rank, schema), "hot_keys")
    by_hot = ranked.where("part IS NOT NULL").select(*hot).groupBy("part").applyInArrow(join, "a long, b long")
    counted = found.where("part IS NULL").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    # A pair may share as many hot keys besides as either set has.
    for side in ("a", "b"):
        counted = counted.join(ranked.where("part IS NULL").selectExpr(f"a AS {side}", f"b AS hot_{side}"), side, "left")
    may_share = F.col("shared") + F.least(F.coalesce("hot_a", F.lit(0)), F.coalesce("hot_b", F.lit(0)))
    links = counted.where(may_share >= fewest("a", "b")).select("a", "b")
    return connected_components(links.unionByName(by_hot)).select(F.col("node").alias("code"), F.col("component").alias("cluster"))


# --- 3. Signature trees ---
class SignatureTree:
    """Sets in order of size as leaves, and levels of nodes of FAN_OUT children up to one root.

    For each node of level k: bits[k] is the OR of its sets' bitmaps, least[k] and most[k] the range of their sizes,
    spare[k] the most shingles that a set has beyond the bits that it sets.
    """

    def __init__(self, sizes: np.ndarray, leaves: np.ndarray):
        self.bits, self.least, self.most = [leaves], [sizes], [sizes]
        self.spare = [sizes - np.bitwise_count(leaves).sum(axis=1).astype(np.int64)]
        while len(self.bits[-1]) > 1:
            starts = np.arange(0, len(self.bits[-1]), FAN_OUT)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], starts))
            self.least.append(np.minimum.reduceat(self.least[-1], starts))
            self.most.append(np.maximum.reduceat(self.most[-1], starts))
            self.spare.append(np.maximum.reduceat(self.spare[-1], starts))

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in node, child) of the children one level down."""
        below = len(self.bits[level - 1])
        child = node[:, None] * FAN_OUT + np.arange(FAN_OUT)
        at, column = np.nonzero(child < below)
        return at, child[at, column]


def may_link(x: SignatureTree, kx: int, i: np.ndarray, y: SignatureTree, ky: int, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the largest possible overlap of sets below nodes i of x and j of y is enough for a link.

    A shared shingle sets a shared bit, and a set has at most `spare` shingles beyond one for each of its bits.
    """
    least = least_overlap(np.maximum(x.least[kx][i], y.least[ky][j]), percent)
    fits = np.minimum(x.most[kx][i], y.most[ky][j]) >= least
    i, j, least = i[fits], j[fits], least[fits]
    both = -(-(x.least[kx][i] + y.least[ky][j]) * percent // (100 + percent))
    shared = np.zeros(len(i), np.int64)
    for start in range(0, len(i), 4096):
        s = slice(start, start + 4096)
        shared[s] = np.bitwise_count(x.bits[kx][i[s]] & y.bits[ky][j[s]]).sum(axis=1)
    overlap = shared + np.minimum(x.spare[kx][i], y.spare[ky][j])
    out = np.zeros(len(fits), bool)
    out[np.flatnonzero(fits)] = overlap >= np.maximum(both, least)
    return out


def candidate_pairs(x: SignatureTree, y: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (i, j) that a dual traversal from both roots can't rule out; i < j where x is y."""
    kx, ky = len(x.bits) - 1, len(y.bits) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        good = may_link(x, kx, i, y, ky, j, percent)
        i, j = i[good], j[good]
        if kx == ky == 0:
            break
        if kx >= ky:
            at, child = x.children(kx, i)
            i, j, kx = child, j[at], kx - 1
            if x is y:
                at, child = y.children(ky, j)
                i, j, ky = i[at], child, ky - 1
                keep = i <= j if kx else i < j
                i, j = i[keep], j[keep]
        else:
            at, child = y.children(ky, j)
            i, j, ky = i[at], child, ky - 1
    keep = i < j if x is y else np.ones(len(i), bool)
    return i[keep], j[keep]


def _trees(sizes: np.ndarray, packed: list[bytes], own: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each width of bitmap, in 64-bit words: places of the sets in order of size, their sizes and bitmaps."""
    words = np.array([len(packed[k]) // 8 for k in own.tolist()], np.int64)
    out = {}
    for width in np.unique(words).tolist():
        at = own[words == width]
        at = at[np.argsort(sizes[at], kind="stable")]
        out[width] = (at, sizes[at], np.frombuffer(b"".join(packed[k] for k in at.tolist()), np.uint64).reshape(len(at), width))
    return out


def tree_pairs(sizes: np.ndarray, packed: list[bytes], left: np.ndarray, right: np.ndarray | None, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of left and right, or within left if right is None, that trees of their bitmaps can't rule out.

    Sets that may link differ in width by one power of two at most; the wider ones are folded then.
    """
    x = _trees(sizes, packed, left)
    y = x if right is None else _trees(sizes, packed, right)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def join(a: tuple, b: tuple, same: bool) -> None:
        first = SignatureTree(a[1], a[2])
        i, j = candidate_pairs(first, first if same else SignatureTree(b[1], b[2]), percent)
        found.append((a[0][i], b[0][j]))

    for width in x:
        if width in y:
            join(x[width], y[width], right is None)
        if 2 * width in y:
            join(x[width], (*y[2 * width][:2], folded(y[2 * width][2])), False)
        if right is not None and width % 2 == 0 and width // 2 in y:
            join((*x[width][:2], folded(x[width][2])), y[width // 2], False)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def join_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, percent: int = PERCENT, known: list | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever sets are connected by links of left to right, or within left if right is None.

    Pairs that are connected already, or have equal values in known, are not compared.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    i, j = tree_pairs(sizes, [signature(s) for s in sets], left, right, percent)
    first = {c: k for k, c in reversed(list(enumerate(known)))} if known else {}
    parent = [first[c] for c in known] if known else list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    links = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q and linked(sets[a], sets[b], percent):
            parent[max(p, q)] = min(p, q)
            links.append((a, b))
    return links


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each set: how many rows link to it across left and right, or within left, and the smallest place that it is connected to."""
    sizes = np.array([len(s) for s in sets], np.int64)
    i, j = tree_pairs(sizes, [signature(s) for s in sets], left, right, percent)
    good = np.fromiter((linked(sets[a], sets[b], percent) for a, b in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
    i, j = i[good], j[good]
    links = np.zeros(len(sets), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    return links, roots(len(sets), i, j)


def _cut(members: DataFrame, block_sets: int, *keys: str) -> DataFrame:
    """(keys, sets, blocks): how many blocks the members of each key fill."""
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("n"))
    return sizes.select(*keys, "sets", F.ceil(F.greatest(F.col("sets") / block_sets, F.col("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))


def _paired(rows: DataFrame) -> DataFrame:
    """rows with `block` and `other` as the two blocks lo and hi. Else the blocks of one cluster would stay in the task to which a join brought the cluster."""
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other")
    return rows.repartition(task_count(rows.sparkSession), "cluster", "lo", "hi")


def _all_blocks(members: DataFrame, block_sets: int) -> DataFrame:
    """members (cluster, class, n and more) with lo, hi, block: every pair of blocks of a cluster gets the rows of both."""
    cut = _cut(members, block_sets, "cluster").drop("sets")
    # Only clusters of several blocks are looked up; all others are one.
    rows = members.join(cut.where("blocks > 1"), "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.struct(F.lit(0).cast("long").alias("owner"), F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("part")))
    others = F.transform(F.expr("sequence(0, blocks - 1)"), lambda k: F.struct(F.lit(0).cast("long").alias("owner"), k.cast("int").alias("part")))
    return _paired(rows.withColumn("other", F.explode(others)).drop("blocks"))


def _own_blocks(members: DataFrame, block_sets: int) -> DataFrame:
    """members with lo, hi, block: each block by itself."""
    cut = _cut(members, block_sets, "cluster").drop("sets")
    rows = members.join(cut.where("blocks > 1"), "cluster", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.struct(F.lit(0).cast("long").alias("owner"), F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("part")))
    return _paired(rows.withColumn("other", F.col("block")).drop("blocks"))


def _open_blocks(members: DataFrame, block_sets: int) -> DataFrame:
    """members (cluster, class, component, n and more) with lo, hi, block: pairs of blocks that may hold links between two components.

    A component of half a block or more has blocks of its own, which are not paired with each other; smaller ones of a cluster share blocks,
    which are also paired with themselves.
    """
    sizes = _cut(members, block_sets, "cluster", "component").withColumn("large", (F.col("sets") * 2 >= block_sets) | (F.col("blocks") > 1))
    small = members.join(sizes.where("NOT large").select("cluster", "component"), ["cluster", "component"])
    pools = _cut(small, block_sets, "cluster").select("cluster", F.col("blocks").alias("pools"))
    rows = members.join(sizes.select("cluster", "component", "blocks", "large"), ["cluster", "component"]).join(pools, "cluster", "left")
    own = F.struct(F.col("component").alias("owner"), F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("part"))
    shared = F.struct(F.lit(-1).cast("long").alias("owner"), F.pmod(F.xxhash64("component"), "pools").cast("int").alias("part"))
    rows = rows.withColumn("block", F.when(F.col("large"), own).otherwise(shared)).drop("blocks", "large", "pools")
    known = rows.select("cluster", "block").distinct().groupBy("cluster").agg(F.collect_list("block").alias("known"))
    rows = rows.join(known, "cluster")
    others = F.filter("known", lambda b: (b["owner"] != F.col("block.owner")) | (b["owner"] == -1))
    return _paired(rows.withColumn("other", F.explode(others)).drop("known"))


def _moved(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """rows with their component moved to the class b that stars (a, b) hang it on."""
    hung = stars.select(F.col("a").alias("component"), F.col("b").alias("on"))
    return rows.join(hung, "component", "left").withColumn("component", F.coalesce("on", "component")).drop("on")


def _rooted(stars: DataFrame) -> DataFrame:
    """(node, component) of every node of stars (a, b), where each a has one b and no b is an a."""
    return stars.selectExpr("a AS node", "b AS component").unionByName(stars.selectExpr("b AS node", "b AS component").distinct())


def _spanning_groups(members: DataFrame, block_sets: int, join) -> DataFrame:
    """(node, component) of every class that is connected to another one within the clusters of members (cluster, class, n and more); component is the smallest class reachable.

    join takes the rows of a pair of blocks, with lo, hi, block and component, and returns stars: for each class a that is connected to a
    smaller one the smallest, b. The stars of a cluster of one block are its components. For larger ones, the last joins link components, and only these
    links are followed further.
    """
    def joined(blocks: DataFrame) -> DataFrame:
        return cut_lineage(blocks.groupBy("cluster", "lo", "hi").applyInArrow(join, "a long, b long"), "block_links")

    members = members.withColumn("component", F.col("class"))
    stars = joined(_own_blocks(members, block_sets))
    several = _cut(members, block_sets, "cluster").where("blocks > 1").select("cluster")
    if several.isEmpty():
        return _rooted(stars)
    large = first = cut_lineage(_moved(members.join(several, "cluster"), stars), "large_clusters")
    before, now = None, large.count()
    while before is None or now * 2 <= before:
        # The smallest class of every component stands for it; each is in one block, so that a round's stars tell where its component moves.
        standing = large.where("class = component")
        before, now = now, standing.count()
        large = cut_lineage(_moved(large, joined(_own_blocks(standing, block_sets))), "large_clusters")
    # Every set goes by its component here, so that links within one say nothing.
    between = connected_components(joined(_open_blocks(large, block_sets).withColumn("class", F.col("component"))))
    hung = _moved(large, between.where("node > component").selectExpr("node AS a", "component AS b")).where("class > component")
    small = stars.join(first.select(F.col("class").alias("a")), "a", "left_anti")
    return _rooted(cut_lineage(small.unionByName(hung.selectExpr("class AS a", "component AS b")), "stars"))


def _sides(part: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray | None]:
    """The rows of a pair of blocks by class, and the places of either block; None for the second if it is the first."""
    part = part.sort_by("class")
    block, lo, hi = part.column("block").to_pylist(), part.column("lo")[0].as_py(), part.column("hi")[0].as_py()
    first = np.array([b == lo for b in block], bool)
    return part, np.flatnonzero(first), None if lo == hi else np.flatnonzero(~first)


def _stars(part: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
    """(a, b): each class of part, sorted by class, that links between places i and j connect to a smaller one, with the smallest."""
    ids = part.column("class").to_numpy()
    root = roots(len(ids), i, j)
    at = np.flatnonzero(root != np.arange(len(ids)))
    return pa.table({"a": pa.array(ids[at], pa.int64()), "b": pa.array(ids[root[at]], pa.int64())})


def _signature_groups(members: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """(node, component) of the classes of members (cluster, class, n, bits) that trees join to another one; all pairs of blocks are joined unless spanning."""

    def join(part: pa.Table) -> pa.Table:
        part, left, right = _sides(part)
        return _stars(part, *tree_pairs(part.column("n").to_numpy(), part.column("bits").to_pylist(), left, right, percent))

    if spanning:
        return _spanning_groups(members, BLOCK_BITMAPS, join)
    return connected_components(_all_blocks(members, BLOCK_BITMAPS).groupBy("cluster", "lo", "hi").applyInArrow(join, "a long, b long"))


# --- 4. Exact comparison ---
def _gathered(docs: DataFrame, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """(cluster, class, n, hashes) of the sets that wanted (code, digest, class, cluster) names, every digest once.

    Sets are sifted by a mark of MARK_BITS bits before they are shuffled. It tells the others apart as long as the
    wanted sets are fewer than its bits; beyond that more sets travel to the join, which drops them.
    """
    place = F.expr(f"pmod(shiftrightunsigned(code, {SIZE_BITS}), {MARK_BITS}L) + 1")
    marked = wanted.select(place.alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("bucket"))
    bits = np.zeros(MARK_BITS // 8, np.uint8)
    for r in marked.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits")).collect():
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["bucket"] - 1) * len(own) : r["bucket"] * len(own)] = own
    marks = docs.sparkSession.sparkContext.broadcast(bits.tobytes())

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sent = marks.value, set()
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                hashes = shingles(text, words)
                if not len(hashes):
                    continue
                digest, code = _describe(hashes)
                place = ((code & (1 << 64) - 1) >> SIZE_BITS) % MARK_BITS
                if not bits[place // 8] >> place % 8 & 1 or digest in sent:
                    continue
                if len(sent) >= MEMO:
                    sent.clear()
                sent.add(digest)
                rows.append((digest, len(hashes), hashes.tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            types = [pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["digest", "n", "hashes"])
        release_memory()

    sets = docs.select(F.col(text_col)).mapInArrow(sift, "digest binary, n long, hashes binary")
    return sets.join(wanted.select("digest", "class", "cluster"), "digest").dropDuplicates(["digest"]).select("cluster", "class", "n", "hashes")


def _exact_groups(members: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes of members (cluster, class, n, hashes) that links connect to another one."""

    def join(part: pa.Table) -> pa.Table:
        part, left, right = _sides(part)
        sets = [np.frombuffer(h, np.uint64) for h in part.column("hashes").to_pylist()]
        found = np.array(join_block(sets, left, right, percent, part.column("component").to_pylist()), np.int64).reshape(-1, 2)
        return _stars(part, found[:, 0], found[:, 1])

    return _spanning_groups(members, BLOCK_SETS, join)


def _counted_links(members: DataFrame, percent: int) -> DataFrame:
    """(class, links, root): for members (cluster, class, n, copies, hashes), the rows that link to a class within a pair of blocks, and the smallest class connected there."""

    def join(part: pa.Table) -> pa.Table:
        part, left, right = _sides(part)
        ids = part.column("class").to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in part.column("hashes").to_pylist()]
        links, root = block_links(sets, left, right, part.column("copies").to_numpy(), percent)
        hit = np.flatnonzero(links)
        return pa.table({"class": pa.array(ids[hit], pa.int64()), "links": pa.array(links[hit]), "root": pa.array(ids[root[hit]], pa.int64())})

    found = _all_blocks(members, BLOCK_SETS).groupBy("cluster", "lo", "hi").applyInArrow(join, "class long, links long, root long")
    return cut_lineage(found, "counted_links")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, component) of every row; with count_links also n_links, the number of rows that link to it.

    Two rows link when 100 |A & B| >= percent |A | B| for their sets of shingles. A row whose text is null or
    without words has an empty set, links with nothing and is a component of its own. component_id is the
    smallest doc_id reachable by links, null ids aside; repeated ids and rows are nodes by their own text, and link with their copies.
    component numbers the component of a non-empty set, also where all its ids are null; null for an empty set.

    All links count, none is capped: the clusters hold every pair that may link, and pairs are left out only where they
    can't link or, unless links are counted, are connected already. Counting compares all pairs that the trees leave, so that its work
    grows with the number of links; components alone take work in proportion to the sets.
    """
    spark = docs.sparkSession
    described = cut_lineage(_sets(docs, id_col, text_col, words), "sets")
    rows = described.where("chunk IS NULL").select("doc_id", "n", "digest", "code", "bits")
    rarity = spark.sparkContext.broadcast(_rarity(described.where("chunk IS NOT NULL")))
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), *(F.any_value(c).alias(c) for c in ("n", "code", "bits")))
    classes = cut_lineage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    clusters = _clusters(docs, text_col, words, percent, rarity)
    near = _signature_groups(classes.join(clusters, "code").select("cluster", "class", "n", "bits"), percent, not count_links)
    wanted = cut_lineage(classes.select("code", "digest", "class").join(near.selectExpr("node AS class", "component AS cluster"), "class"), "wanted")
    members = cut_lineage(_gathered(docs, text_col, words, wanted), "members")
    counted = classes.select("class", (F.col("copies") - 1).alias("links"))
    if count_links:
        found = _counted_links(members.join(classes.select("class", "copies"), "class"), percent)
        groups = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
        counted = counted.unionByName(found.select("class", "links")).groupBy("class").agg(F.sum("links").alias("links"))
    else:
        groups = _exact_groups(members, percent)
    groups = classes.select("class", "least").join(groups.withColumnRenamed("node", "class"), "class")
    first = groups.groupBy("component").agg(F.min("least").alias("first"))
    groups = groups.join(first, "component").select("class", "component", "first")
    named = classes.join(groups, "class", "left").join(counted, "class")
    named = named.select("digest", F.coalesce("component", "class").alias("component"), F.coalesce("first", "least").alias("first"), "links")
    filled = rows.where("n > 0").join(named, "digest").selectExpr("doc_id", "n AS n_shingles", "first AS component_id", "component", "links AS n_links")
    empty = rows.where("n = 0").selectExpr("doc_id", "n AS n_shingles", "doc_id AS component_id", "CAST(NULL AS LONG) AS component", "0L AS n_links")
    found = filled.unionByName(empty)
    return found if count_links else found.drop("n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, mark_bits: int = KEPT_BITS) -> DataFrame:
    """The rows of docs that stay when each component of jaccard_join() keeps one: that of the smallest id, a null id last.

    Ids that repeat are told apart by their texts; of rows equal in both one stays. Rows without words all stay. Columns may have any names.

    Rows are looked up by their key only where marks of bounded size leave their fate open; a row that is surely kept, or surely not, does
    not move.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("text"))
    found = jaccard_join(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", words, percent)
    stays = F.col("component").isNull() | (F.col("doc_id") == F.col("component_id"))
    fates = found.groupBy(F.col("doc_id").alias("key")).agg(F.bool_or(stays).alias("stays"), F.when(F.max("component").isNull(), 1).otherwise(F.count(F.lit(1))).alias("n"))
    fates = cut_lineage(fates.withColumn("hash", F.xxhash64("key")), "fates")
    marks = cut_lineage(mark_table(fates, mark_bits, special="NOT stays OR n > 1", staying="stays"), "marks")
    rows = docs.select(as_row(docs).alias("row"), key.alias("key"))
    rows = with_marks(rows.withColumn("hash", F.xxhash64("key")), marks, mark_bits)
    plain = rows.where(~marked("special")).select("row")
    # Marked as special, and perhaps as staying: by chance, or because it repeats.
    open_ = rows.where(marked("special") & marked("staying")).select("row", "key").join(fates.where("stays").select("key", "n"), "key")
    again = open_.where("n > 1").groupBy("key").agg(F.any_value("row").alias("row")).select("row")
    return from_row(plain.unionByName(open_.where("n = 1").select("row")).unionByName(again), docs.columns)
