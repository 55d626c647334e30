"""Near-duplicate vectors by int8 tile products with an error bound for every vector.

Equal vectors of a label become one class. A class's unit vector u is quantised once: u is scale * code + e, so for two of them
u.w = s_u s_w (code_u . code_w) + s_u code_u . e_w + e_u . w, and the last two terms are at most
(1 + |e_u|) |e_w| + |e_u|. Classes fall into tiles, and each pair of tiles of a label is one product of int8 codes; only
codes, steps and error lengths travel to it. By the bound a pair is above the threshold, below it, or in doubt. Full
vectors travel only to those pairs of tiles in which their class is in doubt, and only pairs in doubt are computed from them in
double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally.llm.common import task_count
from sievetally.llm.components import connected_components
from sievetally.llm.topk import usable
from sievetally.session import cut_lineage

TILE_ROWS = 2048
# Rows of one side multiplied at a time.
STRIP_ROWS = 512
# Covers the rounding of the bound's own arithmetic.
ROUNDING = 1e-6


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, errors) of the unit vectors of rows: int8 codes, the step of each row and the length of what the code leaves out."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    errors = np.linalg.norm(unit - codes * scales[:, None], axis=1)
    return codes, scales, errors


def balanced(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: an exact change of scale, after which no square is too large or too small."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def judged_pairs(left: tuple, right: tuple, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, sure): pairs of two tiles (codes, scales, errors) that may reach the threshold, and whether they certainly do; for same, i < j only."""
    (a, sa, ea), (b, sb, eb) = left, right
    # Sums of products of int8 codes are whole numbers; float32 holds them up to 2**24, else float64 does.
    kind = np.float32 if a.shape[1] * 127**2 < 2**24 else np.float64
    b = b.astype(kind).T
    for start in range(0, len(a), STRIP_ROWS):
        strip = slice(start, start + STRIP_ROWS)
        about = (a[strip].astype(kind) @ b).astype(np.float64) * sa[strip, None] * sb
        bound = (1 + ea[strip, None]) * eb + ea[strip, None] + ROUNDING
        i, j = np.nonzero(about + bound >= threshold)
        sure = about[i, j] - bound[i, j] >= threshold
        i += start
        if same:
            i, j, sure = i[i < j], j[i < j], sure[i < j]
        yield i, j, sure


def cosines(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the rows i of left and j of right, in double precision."""
    norms = [np.linalg.norm(x, axis=1) for x in (left, right)]
    out = [np.zeros(0)]
    for at in range(0, len(i), 65_536):
        p, q = i[at : at + 65_536], j[at : at + 65_536]
        out.append(np.einsum("ij,ij->i", left[p], right[q]) / (norms[0][p] * norms[1][q]))
    return np.concatenate(out)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node reachable over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two rows link when their labels are equal and not null, their vectors have one dimension and their
    cosine in double precision is at least threshold. A vector that is null, empty or zero or holds null or
    non-finite components, and one whose label is null, links with nothing and is a component of its own.
    Equal rows link with each other also where ids repeat; each row then counts the other.
    component_id is the smallest vec_id reachable, null ids aside; kept says that it is the row's own.

    A tile pair returns, for each class, the number of links and one edge to the class that it hangs
    on, and whether the class is in a pair in doubt, never the pairs themselves, so that a group of near copies stays linear.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    rows = rows.withColumn("ok", F.coalesce(usable() & F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0), F.lit(False)))
    classes = rows.where("ok").groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("class", F.monotonically_increasing_id()).withColumn("dim", F.size("vec"))

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            coded = [encode(balanced(np.array([v], np.float64))) for v in vecs]
            packed = [pa.array([c[0].tobytes() for c in coded], pa.binary()), *(pa.array([float(c[k][0]) for c in coded], pa.float64()) for k in (1, 2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *packed], names=[*batch.schema.names, "codes", "scale", "error"])

    coded = T.StructType([*classes.schema, *T.StructType.fromDDL("codes binary, scale double, error double")])
    classes = cut_lineage(classes.mapInArrow(quantised, coded), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    tiled = classes.select("label", "dim", "class", "n", "codes", "scale", "error").join(sizes, ["label", "dim"])
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("class"), "tiles").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    tiled = tiled.select("label", "dim", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile", "class", "n", "codes", "scale", "error")

    def sides(part: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, bool]:
        """The rows of a pair of tiles by class, the places of either tile, and whether it is one."""
        part = part.sort_by("class")
        tile, lo, hi = part.column("tile").to_numpy(), part.column("lo")[0].as_py(), part.column("hi")[0].as_py()
        return part, np.flatnonzero(tile == lo), np.flatnonzero(tile == hi), lo == hi

    def result(part: pa.Table, i: np.ndarray, j: np.ndarray, doubt: np.ndarray) -> pa.Table:
        """For every class with a link or in doubt: its links, and the smallest class that it hangs on."""
        ids, counts = part.column("class").to_numpy(), part.column("n").to_numpy()
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, counts[j])
        np.add.at(links, j, counts[i])
        hit = np.flatnonzero((links > 0) | doubt)
        own = part.take(pa.array(hit)).select(["label", "dim", "lo", "hi", "tile", "class", "n"])
        return own.append_column("links", pa.array(links[hit])).append_column("root", pa.array(ids[roots(len(ids), i, j)[hit]])).append_column("doubt", pa.array(doubt[hit]))

    def product(part: pa.Table) -> pa.Table:
        part, left, right, same = sides(part)
        codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.int8).reshape(len(part), -1)
        tiles = [(codes[x], *(part.column(c).to_numpy()[x] for c in ("scale", "error"))) for x in (left, right)]
        doubt, found = np.zeros(len(part), bool), [(left[:0], right[:0])]
        for i, j, sure in judged_pairs(*tiles, threshold, same) if len(left) and len(right) else ():
            doubt[left[i[~sure]]] = True
            doubt[right[j[~sure]]] = True
            found.append((left[i[sure]], right[j[sure]]))
        return result(part, *(np.concatenate(x) for x in zip(*found, strict=True)), doubt)

    def settle(part: pa.Table) -> pa.Table:
        """The pairs in doubt of a pair of tiles, of whose classes it has the vectors."""
        part, left, right, same = sides(part)
        vecs = balanced(np.array(part.column("vec").to_pylist(), np.float64))
        codes, scales, errors = (np.concatenate(x) for x in zip(*(encode(v[None]) for v in vecs), strict=True))
        tiles = [(codes[x], scales[x], errors[x]) for x in (left, right)]
        found = [(left[:0], right[:0])]
        for i, j, sure in judged_pairs(*tiles, threshold, same) if len(left) and len(right) else ():
            i, j = i[~sure], j[~sure]
            good = cosines(vecs[left], vecs[right], i, j) >= threshold
            found.append((left[i[good]], right[j[good]]))
        return result(part, *(np.concatenate(x) for x in zip(*found, strict=True)), np.zeros(len(part), bool))

    pair = T.StructType([*tiled.schema[:7], *T.StructType.fromDDL("links long, root long, doubt boolean")])
    # Else all pairs of tiles of a label would stay in the task to which the join brought the label.
    tiled = tiled.repartition(task_count(spark), "label", "dim", "lo", "hi")
    first = cut_lineage(tiled.groupBy("label", "dim", "lo", "hi").applyInArrow(product, pair), "tile_links")
    open_ = first.where("doubt").drop("links", "root", "doubt").join(classes.select("class", "vec"), "class")
    open_ = open_.repartition(task_count(spark), "label", "dim", "lo", "hi")
    found = first.unionByName(open_.groupBy("label", "dim", "lo", "hi").applyInArrow(settle, pair)).where("links > 0")
    found = cut_lineage(found.select("class", "links", "root"), "tile_links")
    groups = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    groups = classes.select("class", "least").join(groups.withColumnRenamed("node", "class"), "class")
    least = groups.groupBy("component").agg(F.min("least").alias("first"))
    groups = groups.join(least, "component").select("class", "first")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "class", "left").join(groups, "class", "left")
    classes = classes.select("label", "vec", F.coalesce("first", "least").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    linked = rows.where("ok").select("vec_id", "label", "vec").join(classes, ["label", "vec"]).select("vec_id", F.col("links").alias("n_links"), F.col("first").alias("component_id"))
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
