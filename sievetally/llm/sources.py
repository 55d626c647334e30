"""How the sources of a language differ in their words, counted over collapsed duplicates.

Texts that occur more than once in a language are brought together, with the number of their copies in
every source, and split into terms once; a text that occurs once is split where it is read. Both give sums of
documents and occurrences for each language, source and term. Two sources are then compared on
the terms that both have; what is left of their sum depends on how often each count occurs in
one of them alone, and on the number of terms that neither has.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievetally.llm.common import release_memory
from sievetally.llm.terms import LETTERS, mark_table, marked, term_counts, term_runs, with_marks
from sievetally.session import cut_lineage

# Bits of the marks of texts that occur more than once: 4 MB. With more such texts than an eighth of that, more single ones are
# shuffled with them.
MARK_BITS = 1 << 25
# Sums that a task holds before it sends them.
FLUSH_SUMS = 400_000
SCALE = 1_000_000_000


class Sums:
    """Documents and occurrences by language, source and term, of one task."""

    def __init__(self):
        self.docs: dict[tuple, Counter] = defaultdict(Counter)
        self.n: dict[tuple, Counter] = defaultdict(Counter)
        self.size = 0

    def add(self, lang: str, source: str, counts: dict[bytes, int], copies: int) -> None:
        docs, n = self.docs[lang, source], self.n[lang, source]
        before = len(n)
        docs.update(dict.fromkeys(counts, copies))
        n.update({t: copies * c for t, c in counts.items()})
        self.size += len(n) - before

    def add_text(self, lang: str, source: str, text: bytes) -> None:
        docs, n = self.docs[lang, source], self.n[lang, source]
        before, own = len(n), set()
        for terms in term_runs(text, LETTERS):
            n.update(terms)
            own.update(terms)
        docs.update(own)
        self.size += len(n) - before

    def batches(self) -> Iterator[pa.RecordBatch]:
        """All sums so far; they start anew."""
        for (lang, source), n in self.n.items():
            terms, docs = list(n), self.docs[lang, source]
            columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array([docs[t] for t in terms], pa.int64()), pa.array(n.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "docs", "n"])
        self.__init__()


SUMS = "lang string, source string, term binary, docs long, n long"


def _single_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows (lang, source, text)."""
    sums = Sums()
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums.add_text(lang, source, text)
            if sums.size >= FLUSH_SUMS:
                yield from sums.batches()
    yield from sums.batches()
    release_memory()


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, key, text) with the terms of the text and their counts."""
    for batch in batches:
        bags = [term_counts(t, LETTERS) for t in batch.column(2).to_pylist()]
        terms = pa.array([list(b) for b in bags], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, pa.array([list(b.values()) for b in bags], pa.list_(pa.int64()))], names=["lang", "key", "terms", "counts"])
    release_memory()


def _copied_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows (lang, source, copies, terms, counts)."""
    sums = Sums()
    for batch in batches:
        for lang, source, copies, terms, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums.add(lang, source, dict(zip(terms, counts, strict=True)), copies)
            if sums.size >= FLUSH_SUMS:
                yield from sums.batches()
    yield from sums.batches()
    release_memory()


def term_sums(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", mark_bits: int = MARK_BITS) -> DataFrame:
    """(lang, source, term, docs, n): in how many documents of a source a term stands, and how often; term is in UTF-8.

    Null texts, languages and sources are empty ones. Equal texts of a language are split once and weighted
    by their copies. Only texts that may have copies are shuffled, each once from every task at most.
    """
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    rows = rows.withColumn("hash", F.xxhash64("lang", "text"))
    repeated = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    marks = cut_lineage(mark_table(repeated, mark_bits, again="TRUE"), "marks")
    rows = with_marks(rows, marks, mark_bits).withColumn("key", F.md5(F.col("text").cast("binary"))).withColumn("again", marked("again"))
    single = rows.where("NOT again").select("lang", "source", F.col("text").cast("binary")).mapInArrow(_single_sums, SUMS)
    again = rows.where("again")
    copies = again.groupBy("lang", "key", "source").agg(F.count(F.lit(1)).alias("copies"))
    bags = again.groupBy("lang", "key").agg(F.any_value(F.col("text").cast("binary")).alias("text")).mapInArrow(_split, "lang string, key string, terms array<binary>, counts array<long>")
    copied = copies.join(bags, ["lang", "key"]).select("lang", "source", "copies", "terms", "counts").mapInArrow(_copied_sums, SUMS)
    # Tasks have added up what they could, so sums are shuffled as they are; all that is known of a term meets in one task, a row for each task and source.
    parts = single.unionByName(copied).repartition("lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact."""
    whole = count.cast("decimal(20,0)") + 2
    return F.call_function("div", whole * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)") + 2 * kept.cast("decimal(19,0)")) + 1


def _distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) for shares, which are at most 10^9 + 1, so that squares fit a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def divergence(docs: DataFrame, least_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of a language, the other sources and the words that set it apart.

    Each language keeps the terms (runs of ASCII letters and of characters beyond ASCII, A-Z in lower case) that stand in at least
    least_docs of its documents. A kept term's share is 1 + floor(10^9 (count + 2) / (N + 2 V)), with V kept terms and
    N of their occurrences in the source, or in the whole language. Two shares p and q are floor((p - q)^2 / (p + q)) apart.
    Part `pair` has every other source of the language and the sum over all kept terms, 0 where none is kept; part `term` the `top`
    kept terms of the source with a share above the language's. rank counts from 1 for each source and
    part, by value descending, then item in the order of its UTF-8. Null texts, languages and sources are empty ones; every
    row counts, repeated ones too; an empty table has no rows.
    """
    sums = term_sums(docs, text_col, lang_col, source_col)
    groups = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
    # One entry for each source that has the term.
    terms = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("by_source"))
    counts = terms.where(F.col("docs") >= least_docs).select("lang", "term", "lang_n", F.explode("by_source").alias("of")).select("lang", "of.source", "term", "of.n", "lang_n")
    counts = cut_lineage(counts, "kept_terms")
    langs = counts.groupBy("lang", "term").agg(F.any_value("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["kept", "lang_total", "total"])
    groups = groups.withColumn("none", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))))
    groups = cut_lineage(groups, "source_totals")

    known = groups.where("kept > 0").drop("lang_n")
    shares = counts.join(known, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
    shares = cut_lineage(shares.withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).select("lang", "source", "term", "p", "q", "none"), "shares")

    words = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), _distance("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    words = words.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # For each pair, every term as if neither source had it, then what changes where one has it, then where both have it.
    pairs = groups.selectExpr("lang", "source AS a", "none AS none_a", "kept").join(groups.selectExpr("lang", "source AS b", "none AS none_b"), "lang").where("a <> b")
    base = pairs.select("lang", "a", "b", F.coalesce(F.col("kept") * _distance("none_a", "none_b"), F.lit(0)).alias("value"))
    levels = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("terms"))
    alone = levels.join(pairs.where("kept > 0"), ["lang", "a"]).withColumn("value", F.col("terms") * (_distance("p", "none_b") - _distance("none_a", "none_b")))
    alone = alone.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    left, right = (shares.selectExpr("lang", "term", f"source AS {x}", f"p AS p_{x}", f"none AS none_{x}") for x in "ab")
    both = left.join(right, ["lang", "term"]).where("a < b")
    change = _distance("p_a", "p_b") - _distance("p_a", "none_b") - _distance("none_a", "p_b") + _distance("none_a", "none_b")
    both = both.groupBy("lang", "a", "b").agg(F.sum(change).alias("value"))
    # The distance is the same both ways.
    ways = [base, alone, alone.selectExpr("lang", "b AS a", "a AS b", "value"), both, both.selectExpr("lang", "b AS a", "a AS b", "value")]
    total = ways[0]
    for way in ways[1:]:
        total = total.unionByName(way)
    total = total.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).selectExpr("lang", "a AS source", "'pair' AS part", "b AS item", "value")
    total = total.withColumn("rank", F.row_number().over(order))
    return total.unionByName(words).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
