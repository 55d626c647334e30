"""Ranked lexical search of many queries at once, by common subexpressions.

Documents are read once into a table of the terms that any query asks for. A document's score for a query is a sum over
the query's terms, so queries that share terms share parts of their sums. Those parts are mined among similar queries:
terms that the same queries hold become one shared set, and then, again and again, the two parts that most queries take
together become a part of their own. The result is a graph in which every shared part has its partial
scores (accumulators over a block of documents) added up once, and a query adds up the few parts that are left.

Queries go in batches of bounded size, each of which reads the table of documents once.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievetally.llm.common import release_memory, spread, task_count
from sievetally.llm.terms import LETTERS_AND_DIGITS, term_counts
from sievetally.session import cut_lineage

# Bytes of the distinct term sets of one batch of queries, about; its terms, weights and graphs are broadcast.
BATCH_BYTES = 4 * 1024 * 1024
# Queries that are mined together, about.
GROUP_QUERIES = 256
# Parts that may be paired in a group, those that most queries take; the others are shared without being paired. No bound on results.
PAIRED_PARTS = 1024
# Documents of a block, about.
BLOCK_DOCS = 1024
# Partial top lists of a query are merged in so many parts first.
MERGE_PARTS = 64
MOST_LONG = 2**63 - 1


# --- Sharing ---
@dataclass
class Sharing:
    """A graph of shared parts. A part >= 0 is a term, a part < 0 is node -1 - part; nodes and queries are lists of parts to add up, a node's being terms or earlier nodes."""

    nodes: list[list[int]]
    queries: list[list[int]]


def mine(queries: list[list[int]], paired_parts: int = PAIRED_PARTS) -> Sharing:
    """Shared parts of the given sets of terms. Every set is the disjoint union of what its parts stand for."""
    holders: dict[int, int] = defaultdict(int)
    for i, terms in enumerate(queries):
        for t in terms:
            holders[t] |= 1 << i
    same: dict[int, list[int]] = defaultdict(list)
    for t in sorted(holders):
        if holders[t].bit_count() > 1:
            same[holders[t]].append(t)
    nodes: list[list[int]] = []
    takers: dict[int, int] = {}
    for who, terms in same.items():
        if len(terms) > 1:
            nodes.append(terms)
        takers[-len(nodes) if len(terms) > 1 else terms[0]] = who
    open_ = sorted(takers, key=lambda p: (-takers[p].bit_count(), p))[:paired_parts]
    heap = [(-n, a, b) for k, a in enumerate(open_) for b in open_[k + 1 :] if (n := (takers[a] & takers[b]).bit_count()) > 1]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        both = takers[a] & takers[b]
        if both.bit_count() < 2:
            continue
        if both.bit_count() < -n:
            heapq.heappush(heap, (-both.bit_count(), a, b))
            continue
        nodes.append([a, b])
        new = -len(nodes)
        takers[a] &= ~both
        takers[b] &= ~both
        for c in open_:
            if (m := (takers[c] & both).bit_count()) > 1:
                heapq.heappush(heap, (-m, c, new))
        takers[new] = both
        open_ = [p for p in open_ if takers[p].bit_count() > 1] + [new]
    left = [[t for t in terms if holders[t].bit_count() == 1] for terms in queries]
    for part, who in takers.items():
        while who:
            left[(who & -who).bit_length() - 1].append(part)
            who &= who - 1
    return Sharing(nodes, left)


# --- Scores of a block ---
class Block:
    """Documents with their scores for single terms: those of a term stand together."""

    def __init__(self, ids: pa.Array, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids = np.asarray(ids.fill_null(MOST_LONG))
        self.unknown = np.asarray(ids.is_null())
        self.size = len(lengths)
        if int(lengths.max(initial=0)) * 90 * n_docs <= MOST_LONG:
            m = 10 + 90 * lengths * n_docs // n_terms
        else:
            m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        doc = np.repeat(np.arange(self.size), np.diff(starts))
        scores = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[doc]))
        order = np.argsort(terms, kind="stable")
        own, first = np.unique(terms[order], return_index=True)
        ends = np.append(first[1:], len(order))
        self.docs, self.scores = doc[order], scores[order]
        self.places = dict(zip(own.tolist(), zip(first.tolist(), ends.tolist(), strict=True), strict=True))

    def total(self, parts: list[int], nodes: list[np.ndarray | None]) -> np.ndarray | None:
        """The accumulator over all documents of a sum of parts; None where no document has any of them."""
        out = None
        for part in parts:
            if part < 0:
                if nodes[-1 - part] is not None:
                    out = nodes[-1 - part].copy() if out is None else np.add(out, nodes[-1 - part], out=out)
            elif part in self.places:
                a, b = self.places[part]
                out = np.zeros(self.size, np.int64) if out is None else out
                out[self.docs[a:b]] += self.scores[a:b]
        return out


class Top:
    """The k best documents of one query so far: highest score first, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k, self.cut = k, 1
        self.scores, self.ids, self.unknown = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, total: np.ndarray, block: Block) -> None:
        at = np.flatnonzero(total >= self.cut)
        if not len(at):
            return
        scores, ids, unknown = np.append(self.scores, total[at]), np.append(self.ids, block.ids[at]), np.append(self.unknown, block.unknown[at])
        best = np.lexsort((ids, unknown, -scores))[: self.k]
        self.scores, self.ids, self.unknown = scores[best], ids[best], unknown[best]
        if len(best) == self.k:
            self.cut = int(self.scores[-1])


# --- On Spark ---
def _query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, key, terms) of every row with a term: its distinct terms, sorted, and their digest."""

    @F.pandas_udf("array<binary>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(term_counts(t, LETTERS_AND_DIGITS)) for t in texts], dtype=object)

    rows = items.select(F.col(item_col).alias("item"), terms(F.col(text_col).cast("binary")).alias("terms")).where(F.size("terms") > 0)
    return rows.withColumn("key", F.md5(F.array_join(F.transform("terms", F.hex), " ").cast("binary")))


def _postings(docs: DataFrame, id_col: str, text_col: str, numbers) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its number of terms, and which of the numbered ones it has how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            ids, ns, terms, counts, starts = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = term_counts(text, LETTERS_AND_DIGITS)
                if own:
                    ids.append(doc)
                    ns.append(own.total())
                    found = sorted((known[t], n) for t, n in own.items() if t in known)
                    terms += [t for t, _ in found]
                    counts += [n for _, n in found]
                    starts.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])
        release_memory()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<int>")


def _sharings(classes: DataFrame, numbers) -> DataFrame:
    """(keys, nodes, queries): the shared parts of each group of classes (key, terms). Groups hold classes that are likely to share terms."""

    def share(part: pa.Table) -> pa.Table:
        part = part.sort_by("key")
        known = numbers.value
        found = mine([[known[t] for t in terms] for terms in part.column("terms").to_pylist()])
        lists = pa.list_(pa.list_(pa.int32()))
        return pa.table([pa.array([part.column("key").to_pylist()]), pa.array([found.nodes], lists), pa.array([found.queries], lists)], names=["keys", "nodes", "queries"])

    n = classes.count()
    like = F.array_min(F.transform("terms", lambda t: F.xxhash64(t)))
    rows = classes.withColumn("like", F.pmod(like, F.lit(max(1, n // GROUP_QUERIES))))
    sizes = rows.groupBy("like").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("parts"))
    rows = rows.join(sizes, "like").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    return rows.groupBy("like", "part").applyInArrow(share, "keys array<string>, nodes array<array<int>>, queries array<array<int>>")


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rank_classes(docs: DataFrame, classes: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(key, rank, doc_id, score) for one batch of classes (key, terms)."""
    spark = docs.sparkSession
    context = spark.sparkContext
    words = sorted(bytes(r[0]) for r in classes.select(F.explode("terms")).distinct().collect())
    numbers = context.broadcast({w: i for i, w in enumerate(words)})
    index = cut_lineage(_postings(docs, id_col, text_col, numbers), "term_postings")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = np.zeros(len(words), np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    groups = [(r["keys"], Sharing(r["nodes"], r["queries"])) for r in _sharings(classes, numbers).collect()]
    plan = context.broadcast((weights, groups))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK_DOCS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, groups = plan.value
        tops = [[Top(k) for _ in keys] for keys, _ in groups]
        for part in blocks(batches):
            ids, lengths, terms, counts = (part.column(c).combine_chunks() if isinstance(part.column(c), pa.ChunkedArray) else part.column(c) for c in part.column_names)
            starts = np.concatenate([[0], np.cumsum(np.asarray(terms.value_lengths()))])
            block = Block(ids, np.asarray(lengths), starts, np.asarray(terms.flatten()), np.asarray(counts.flatten()).astype(np.int64), weights, n_docs, n_terms)
            for (_, sharing), own in zip(groups, tops, strict=True):
                nodes: list[np.ndarray | None] = []
                for parts in sharing.nodes:
                    nodes.append(block.total(parts, nodes))
                for parts, top in zip(sharing.queries, own, strict=True):
                    total = block.total(parts, nodes)
                    if total is not None:
                        top.add(total, block)
        for (keys, _), own in zip(groups, tops, strict=True):
            n = [len(t.scores) for t in own]
            if sum(n):
                ids = pa.array(np.concatenate([t.ids for t in own]), pa.int64(), mask=np.concatenate([t.unknown for t in own]))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(keys, object), n), pa.string()), ids, pa.array(np.concatenate([t.scores for t in own]), pa.int64())], names=["key", "doc_id", "score"])
        release_memory()

    found = index.mapInArrow(score, "key string, doc_id long, score long")
    # Each task has sent k rows a query at most; with many tasks these are cut down in parts before they meet.
    parts = _best(found.withColumn("part", spread(F.col("doc_id"), MERGE_PARTS)), k, "key", "part").drop("rank", "part")
    return _best(parts, k, "key")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k documents with the highest scores above 0 for every item; ties by ascending doc_id, a null one last.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower case, in whole texts. A document scores the sum
    over an item's distinct terms of w * (10^9 tf div (1000 tf + 8 m)), where w = floor(1000 ln((2 N + 2) / (2 df + 1))),
    m = 10 + 90 n N div L, N documents have a term, L terms in all, n in the document. Null texts have no terms. Every row of either table
    counts for itself, repeated rows and ids included; an item without terms, or one that no document shares a term with, has no rows.
    """
    wanted = cut_lineage(_query_terms(items, item_col, item_text_col), "query_terms")
    size = wanted.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 8))).first()[0] or 0
    batches = max(1, -(-size // batch_bytes))
    classes = wanted.groupBy("key").agg(F.any_value("terms").alias("terms"))
    if batches > 1:
        classes = cut_lineage(classes, "query_classes")
    found = [_rank_classes(docs, classes.where(spread(F.col("key"), batches) == b), k, id_col, text_col) for b in range(batches)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return wanted.select("item", "key").join(best, "key").select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
