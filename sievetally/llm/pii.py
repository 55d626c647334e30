"""Personal data in texts: base patterns, and identifiers found by the contexts that base finds induce.

All of it is column functions, joins and grouped sums. Base finds are the seeds. The words around
a seed are its lexical patterns; other strings of digits or with an @ that stand in the same patterns are
candidates. Patterns and candidate strings form a graph, scored in rounds: a pattern is as sure as the
share of its strings that are sure, a string as sure as its best pattern. What sure patterns with
enough sure strings surround is personal data too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievetally.llm.common import as_row, from_row
from sievetally.llm.terms import mark_table, marked, with_marks
from sievetally.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

# What a find of each kind looks like. A run that can't match is tried once, from its start or from
# where the find before ended, and quantifiers never give back what no later part can use; the finds are
# those of the plain patterns without these aids, but long runs of one character class stay linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these has no find of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": "+"}
# What a base find, or an unseen identifier, stands in: a word with an @, a run of words of digits and signs, or a word of letters and digits.
CANDIDATE = r"(?<!\S)(?:[^\s@]*+@\S*+|[^\s@\p{L}0-9]*+[0-9][^\s@\p{L}]*+(?!\S)(?:\x20[^\s@\p{L}0-9]*+[0-9][^\s@\p{L}]*+(?!\S))*+|[^\s@0-9]*+[0-9][^\s@]*+(?!\S))"
# What of a candidate is the identifier: from its first to its last letter, digit or opening sign.
CORE = r"[\p{L}\p{N}+(](?s:.*[\p{L}\p{N})])?"
# Candidates that may be personal data of a kind at all.
SHAPES = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^[0-9]{1,4}(\.[0-9]{1,4}){3,}$",
    "card": r"^(?=(\D*[0-9]){12,19}\D*$)[0-9][0-9 .-]+[0-9]$",
    "phone": r"^(?=(\D*[0-9]){7,15}\D*$)[+(]?[0-9][0-9 ().-]+[0-9]$",
}
ROUNDS = 3
LEAST_SCORE = 0.8
LEAST_SEEDS = 5
_BLOCK = 256
# Bits of the marks of texts with discovered identifiers: 2 MB. With more such texts than an eighth of that, others are joined with them in vain.
MARK_BITS = 1 << 24
# Parts of the copies of one text where they are joined.
SALT = 16
SPANS = "array<struct<kind:int,start:int,stop:int>>"


def _starts(steps: Column) -> Column:
    """Running sum of an array of lengths: for each the sum up to and with it.

    In blocks, so that the work for n finds is n * _BLOCK, not n * n.
    """
    sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")), lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda a, x: a + x))
    bases = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])
    within = F.transform(steps, lambda _, i: F.element_at(bases, (F.floor(i / _BLOCK) + 1).cast("int")) + F.aggregate(F.slice(steps, (F.floor(i / _BLOCK) * _BLOCK + 1).cast("int"), (i % _BLOCK + 1).cast("int")), F.lit(0), lambda a, x: a + x))
    return F.when(F.size(steps) > 0, within).otherwise(F.array().cast("array<int>"))


def _hint(text: Column, hint: str) -> Column:
    return F.contains(text, F.lit(hint)) if len(hint) == 1 else F.rlike(text, F.lit(hint))


def _valid(kind: str, found: Column) -> Column:
    """Whether a find of the pattern is one of the kind."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        # A part is at most 255: without leading zeros at most three digits, and by number.
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def find(df: DataFrame, text: str, pattern: str, hint: str, out: str, context: bool = False) -> DataFrame:
    """df with `out`: array<struct<start, stop, found>> of the leftmost finds of pattern that do not overlap.

    start and stop count code points, stop exclusive. With `context`, for patterns that find whole words, also before, the two words before the find, the
    nearest first, and after, the word after it; empty where there is none. Temporary columns begin with `out`.
    """
    hits, gaps, ends = f"{out}_hits", f"{out}_gaps", f"{out}_ends"
    near = _hint(F.col(text), hint)
    df = df.withColumn(hits, F.when(near, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(ends, F.when(F.col(gaps).isNotNull(), _starts(F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.length(h) + F.length(g)))))

    def at(column: str, i: Column) -> Column:
        return F.when(i >= 0, F.get(column, i)).otherwise(F.lit(""))

    def described(h: Column, i: Column) -> Column:
        fields = [(F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("stop"), h.alias("found")]
        if context:
            # A find has a word at least, so two finds back and one ahead hold all the words asked for.
            back = F.reverse(F.concat(F.when(i < 2, at(gaps, i - 2)).otherwise(F.lit("")), at(hits, i - 2), at(gaps, i - 1), at(hits, i - 1), F.get(gaps, i)))
            words = [F.reverse(F.regexp_extract(back, r"^\s*(\S+)(?:\s+(\S+))?", k)) for k in (1, 2)]
            ahead = F.concat(F.get(gaps, i + 1), F.coalesce(F.get(hits, i + 1), F.lit("")))
            fields += [F.array(*words).alias("before"), F.regexp_extract(ahead, r"^\s*(\S+)", 1).alias("after")]
        return F.struct(*fields)

    more = ",before:array<string>,after:string" if context else ""
    empty = F.array().cast(f"array<struct<start:int,stop:int,found:string{more}>>")
    return df.withColumn(out, F.when(F.col(gaps).isNotNull(), F.transform(hits, described)).otherwise(empty)).drop(hits, gaps, ends)


def _kept(k: int, finds: Column) -> Column:
    valid = F.filter(finds, lambda s: _valid(KINDS[k], s["found"]))
    return F.transform(valid, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def of_kind(spans: Column, k: int) -> Column:
    """How many of the spans are of the kind at place k of KINDS."""
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with `out`: array<struct<kind, start, stop>> of the valid base finds, by kind as in KINDS, then start. kind is the place in KINDS."""
    for k, kind in enumerate(KINDS):
        df = find(df, text, PATTERNS[kind], HINTS[kind], f"{out}_{k}")
        df = df.withColumn(f"{out}_{k}", _kept(k, F.col(f"{out}_{k}")))
    parts = [f"{out}_{k}" for k in range(len(KINDS))]
    return df.withColumn(out, F.concat(*parts)).drop(*parts)


def _word(word: Column, edge: str) -> Column:
    """A word of a context, in lower case with digits as 0; edge where there is none."""
    return F.when(word == "", F.lit(edge)).otherwise(F.regexp_replace(F.lower(word), "[0-9]", "0"))


def _occurrences(scanned: DataFrame) -> DataFrame:
    """(key, start, stop, value, seed, pattern): each candidate of a text in each of its lexical patterns. seed is the kind of a base find in it.

    Patterns: the two words before it; the words before and after it.
    """
    rows = scanned.select("key", "base", F.explode("candidates").alias("c"))
    core = F.regexp_extract("c.found", CORE, 0)
    rows = rows.select("key", "base", "c", core.alias("value"), (F.instr("c.found", core) - 1 + F.col("c.start")).alias("start"))
    rows = rows.withColumn("stop", F.col("start") + F.length("value")).where("value <> ''")
    inside = F.filter("base", lambda b: (b["start"] < F.col("c.stop")) & (b["stop"] > F.col("c.start")))
    first, second = (_word(F.col("c.before")[k], "<start>") for k in (0, 1))
    patterns = F.array(F.concat_ws(" ", F.lit("<<"), second, first), F.concat_ws(" ", F.lit("<>"), first, _word(F.col("c.after"), "<end>")))
    return rows.select("key", "start", "stop", "value", F.get(inside, F.lit(0))["kind"].alias("seed"), F.explode(patterns).alias("pattern"))


def _shaped() -> Column:
    """Whether a string may be of its kind at all."""
    return reduce(lambda rest, k: F.when(F.col("kind") == k, F.rlike("value", F.lit(SHAPES[KINDS[k]]))).otherwise(rest), range(len(KINDS)), F.lit(False))


def _sure_patterns(seen: DataFrame, rounds: int, least_score: float, least_seeds: int) -> DataFrame:
    """(pattern, kind, score) of the patterns that are sure after the given rounds.

    A pattern's score for a kind is the sum of its strings' scores over their number and one more. Seeds score 1; another
    string scores as the best sure pattern that it stood in after the round before, else 0, so that doubtful patterns and
    strings can't lift each other. A sure pattern has least_score and least_seeds strings that score. Every string
    counts once for a pattern; sums are reduced before the shuffle.
    """
    edges = cut_lineage(seen.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pattern_graph")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_seeds)
    seeds = edges.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("sure")).distinct()
    known = seeds
    for turn in range(rounds):
        support = edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("sure").alias("sure"), F.count(F.lit(1)).alias("strings"))
        patterns = support.where(F.col("strings") >= least_seeds).join(sizes, "pattern").withColumn("score", F.col("sure") / (F.col("n") + 1))
        patterns = cut_lineage(patterns.where(F.col("score") >= least_score).select("pattern", "kind", "score"), "sure_patterns")
        if turn < rounds - 1:
            new = edges.where("seed IS NULL").join(patterns, "pattern").where(_shaped())
            known = seeds.unionByName(new.select("value", "kind", F.col("score").alias("sure"))).groupBy("value", "kind").agg(F.max("sure").alias("sure"))
    return patterns


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """(doc_id, key, base, candidates) of every row, written; key is a digest of the text, which alone decides all finds.

    With keep_rows also the row itself, as a struct `row`, so that whole rows go on from what is written without being shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*([as_row(docs).alias("row")] if keep_rows else []), F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.md5(F.col("text").cast("binary")))
    rows = find(base_spans(rows, "text", "base"), "text", CANDIDATE, "[0-9@]", "candidates", context=True)
    return cut_lineage(rows.drop("text"), "scanned")


def discovered(scanned: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """(key, added): for each text with any, array<struct<kind, start, stop>> of the identifiers that sure patterns surround and that look like their kind."""
    seen = cut_lineage(_occurrences(scanned.dropDuplicates(["key"])), "occurrences")
    sure = _sure_patterns(seen, rounds, least_score, least_seeds)
    new = seen.where("seed IS NULL").join(sure, "pattern").where(_shaped())
    # One kind for each place: the first of KINDS.
    new = new.groupBy("key", "start", "stop").agg(F.min("kind").alias("kind"))
    return new.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("added"))


def _with_added(scanned: DataFrame, mark_bits: int) -> DataFrame:
    """scanned with `spans`: the base finds and the discovered ones, by kind, then start.

    Rows are looked up in the discovered finds only where a mark of bounded size says that their text may have some; all others stay
    where they are. Copies of one text are dealt over SALT parts.
    """
    added = cut_lineage(discovered(scanned), "added")
    marks = cut_lineage(mark_table(added.select(F.xxhash64("key").alias("hash")), mark_bits, may_have="TRUE"), "marks")
    rows = with_marks(scanned.withColumn("hash", F.xxhash64("key")), marks, mark_bits)
    plain = rows.where(~marked("may_have")).withColumn("spans", F.col("base"))
    salted = added.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    looked = rows.where(marked("may_have")).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")).join(salted, ["key", "salt"], "left")
    looked = looked.withColumn("spans", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS)))))
    return plain.select(*scanned.columns, "spans").unionByName(looked.select(*scanned.columns, "spans"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark_bits: int = MARK_BITS) -> DataFrame:
    """(doc_id, base, spans) of every row: array<struct<kind, start, stop>>, by kind as in KINDS, then start.

    spans holds the base finds and the discovered ones. A null text is an empty one and has none; repeated rows and null
    ids stay as they are. Equal texts have equal finds, and count once as evidence.
    """
    return _with_added(scan(docs, id_col, text_col), mark_bits).select("doc_id", "base", "spans")


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind; spans are sorted by start, those of one start by falling stop."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def replace(done: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(done["at"], -s["last"]).alias("at"), F.when(s["start"] < done["at"], done["parts"]).otherwise(F.concat(done["parts"], F.array(piece))).alias("parts"))

    return F.aggregate(spans, start, replace, lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))))


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", mark_bits: int = MARK_BITS) -> DataFrame:
    """docs with every span in text_col replaced by its kind, as in [EMAIL]; overlapping spans by the kind of the first, up to the end of the last.

    Null texts stay null, and all other columns, whatever their names, stay as they are.
    """
    rows = _with_added(scan(docs, id_col, text_col, keep_rows=True), mark_bits)
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("last"), s["kind"].alias("kind"))))
    text = F.col("row").getField(text_col)
    rows = rows.withColumn("spans", order).withColumn("redacted", F.when(F.size("spans") > 0, _redacted(text, F.col("spans"))).otherwise(text))
    return from_row(rows, docs.columns, **{text_col: F.col("redacted")})
