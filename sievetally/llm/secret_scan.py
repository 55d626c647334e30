"""Secrets in texts, found by regular expressions over a trigram inverted index.

Each rule's expression gives a Boolean query of trigrams that any text with a find must hold. The index has, for every
trigram that some rule asks for, the sorted list of the texts that hold it, in shards of texts; a rule's candidates are
the unions and intersections of these lists. Only candidates are searched with the rule's expression; a rule
without a mandatory trigram searches every text. All of it is column functions and grouped lists.

Candidates come back to their texts as marks of bounded size, so no text is shuffled: a marked text that is no candidate is
searched in vain, and no candidate is missed, at any number of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievetally.llm.common import spread
from sievetally.llm.pii import find
from sievetally.llm.terms import mark_table, marked, with_marks
from sievetally.llm.trigrams import Clause, trigram_query, trigrams_of
from sievetally.session import cut_lineage

# Texts of one shard of the index, about: a list has no more entries.
SHARD_TEXTS = 32_768
# Bits of the marks of a rule's candidates: 2 MB. With more candidates than an eighth of that, more texts are searched in vain.
MARK_BITS = 1 << 24


@dataclass(frozen=True)
class Rule:
    """Finds of `pattern` whose group `group` has `least` characters or more; leftmost ones that do not overlap, a find that is too short included in that."""

    name: str
    pattern: str
    least: int = 1
    group: int = 0


# What secrets look like. Quantifiers never give back what no later part can use, and a run of hexadecimal digits
# is tried from its start alone; the finds are those of the plain patterns without these aids.
BASE = (
    Rule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)", 8, 1),
    Rule("access", r"AKIA[A-Z0-9]++", 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+", 32),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)


def _held(query: list[Clause], numbers: dict[str, int]) -> Column:
    """The texts of a shard that satisfy a query, from `lists`, a map from trigram numbers to sorted lists."""
    empty = F.array().cast("array<bigint>")

    def texts(way: frozenset[str]) -> Column:
        return reduce(F.array_intersect, (F.coalesce(F.col("lists")[numbers[t]], empty) for t in sorted(way)))

    clauses = [reduce(F.array_union, (texts(way) for way in sorted(clause, key=sorted))) for clause in query]
    return reduce(F.array_intersect, clauses)


def trigram_index(docs: DataFrame, trigrams: list[str], text_col: str = "text", shard_texts: int = SHARD_TEXTS) -> DataFrame:
    """(shard, trigram, rows): for each place in `trigrams`, lower-case ASCII ones, the sorted hashes of the distinct texts of a shard that hold it, in any case of letters.

    Copies count once, before the shuffle.
    """
    shards = max(1, -(-docs.count() // shard_texts))
    texts = docs.select(F.xxhash64(text_col).alias("row"), F.lower(text_col).alias("lower"))
    held = F.array_compact(F.array(*(F.when(F.contains("lower", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    postings = texts.select(spread(F.col("row"), shards).alias("shard"), "row", F.explode(held).alias("trigram")).distinct()
    return postings.groupBy("shard", "trigram").agg(F.sort_array(F.collect_list("row")).alias("rows"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[int, list[Clause]]) -> DataFrame:
    """(rule, hash) of the texts that satisfy the Boolean query of a rule."""
    numbers = {t: i for i, t in enumerate(trigrams)}
    shards = index.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("lists"))
    found = F.array(*(F.struct(F.lit(rule).alias("rule"), _held(query, numbers).alias("rows")) for rule, query in queries.items()))
    return shards.select(F.explode(found).alias("of")).select("of.rule", F.explode("of.rows").alias("hash"))


def _long_enough(finds: Column, rule: Rule, k: int) -> Column:
    valid = F.filter(finds, lambda s: F.length(F.regexp_extract(s["found"], rule.pattern, rule.group)) >= rule.least)
    return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop")))


def of_kind(spans: Column, k: int) -> Column:
    """How many of the spans are of the rule at place k."""
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE, mark_bits: int = MARK_BITS) -> DataFrame:
    """(doc_id, base, spans) of every row: array<struct<start, kind, stop>> by start, then kind, the place of the rule in base, then more.

    Patterns are in the syntax that Java and Python share. Whole texts count; a null text is an empty one and has
    no finds. Repeated rows and null ids stay as they are, and equal texts have equal finds.
    """
    rules = (*base, *more)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    queries = {k: q for k, rule in enumerate(rules) if (q := trigram_query(rule.pattern))}
    if queries:
        trigrams = sorted(set().union(*map(trigrams_of, queries.values())))
        index = cut_lineage(trigram_index(texts, trigrams), "trigram_index")
        marks = mark_table(candidates(index, trigrams, queries), mark_bits, **{f"rule_{k}": f"rule = {k}" for k in queries})
        texts = with_marks(texts.withColumn("hash", F.xxhash64("text")), cut_lineage(marks, "marks"), mark_bits)
    for k, rule in enumerate(rules):
        text, out = f"text_{k}", f"finds_{k}"
        texts = find(texts.withColumn(text, F.when(marked(f"rule_{k}"), F.col("text")) if k in queries else F.col("text")), text, rule.pattern, rule.pattern, out).drop(text)
        texts = texts.withColumn(out, _long_enough(F.col(out), rule, k))
    parts = [f"finds_{k}" for k in range(len(rules))]
    spans = F.array_sort(F.concat(*parts))
    return texts.select("doc_id", F.array_sort(F.concat(*parts[: len(base)])).alias("base"), spans.alias("spans"))


def span_text(spans: Column, rules: tuple[Rule, ...] = BASE + MORE) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*(F.lit(rule.name) for rule in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
