import pytest
from pyspark.sql import types as T

LONG = "Une phrase sans fin. " * 4000
EDGE_TEXTS = [
    "one two three four five six seven eight nine ten",
    "ONE two three four five six seven eight nine ten",
    "one two three four five six seven eight nine eleven",
    None,
    "",
    "   \n\t ",
    "short",
    "Short",
    "a" * 30_000,
    LONG,
    "é😀 ٣ ñandú straße <|endoftext|> it's  ok\n\n x",
    "mail bob@x.org or call +49 123 456 789 12",
]


@pytest.fixture
def edge_docs(spark):
    """Awkward texts, repeated rows, a null id, and columns named as the operators name theirs."""
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(0, EDGE_TEXTS[0], "en", "s", 0), (None, EDGE_TEXTS[0], None, None, None), (None, None, None, None, None)]
    clash = ["ids", "score", "key", "n", "digest", "item", "row", "length", "code", "class", "component", "file", "base", "hashes", "found", "chunk",
        "__added", "__spans_0", "__key", "__text", "__spans", "__sorted", "__n", "__id", "__language", "__toxicity", "id", "t", "y", "x", "terms", "counts", "stays", "hash", "bucket", "place", "again", "spans", "redacted", "salt", "may_have", "special", "staying", "chosen", "below", "x.y"]
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), *((c, T.StringType()) for c in clash)]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return spark.createDataFrame([(*r, *("x" for _ in clash)) for r in rows], schema).repartition(3)


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)
