"""Flat token files and their documents' token counts, found by scanning for the separator alone.

A token file is a run of little-endian unsigned integers, every document ended by one separator id;
nothing says where documents begin. Blocks of a file are searched apart; a running sum of
separators and a running maximum of their positions over a file's blocks then give every block the
number of documents before it and the start of the document that runs into it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievetally.llm.common import open_new, open_range, qualified
from sievetally.session import cut_lineage, scratch_dir

BLOCK_BYTES = 16 * 1024 * 1024


def write_token_files(docs: DataFrame, tokens: list[bytes], pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, item_bytes: int = 2) -> DataFrame:
    """Tokenises every text into token files, one per task, and returns (file, ordinal, doc_id) of their documents.

    tokens: the vocabulary, bytes by rank. separator must be no rank and fit item_bytes. Special
    tokens are ordinary text; null and empty texts are documents without tokens. The returned
    table is written: it names the files of the tasks that succeeded, not those of lost attempts.
    """
    spark = docs.sparkSession
    if separator < len(tokens) and tokens[separator] or max(separator, len(tokens) - 1) >= 256**item_bytes:
        raise ValueError("the separator is a token, or ids do not fit the item size")
    folder = qualified(spark, folder or scratch_dir(spark, "tokens"))
    vocabulary = spark.sparkContext.broadcast((tokens, pattern))
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("doc_id", docs.schema[id_col].dataType)])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, pattern = vocabulary.value
        encoder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks={t: r for r, t in enumerate(ranks) if t}, special_tokens={})
        uri = f"{folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
        out, ordinal = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or open_new(uri)
            for text in batch.column(1).to_pylist():
                out.write(np.append(encoder.encode_to_numpy(text or "", disallowed_special=()), separator).astype(f"<u{item_bytes}").tobytes())
            ordinals = np.arange(ordinal, ordinal + batch.num_rows)
            ordinal += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([uri] * batch.num_rows, pa.string()), pa.array(ordinals), batch.column(0)], names=schema.names)
        if out:
            out.close()

    return cut_lineage(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(write, schema), "manifest")


def _blocks(files: DataFrame, separator: int, item_bytes: int, block_bytes: int) -> DataFrame:
    """(file, block, first, items, ends): positions of the separators of each block, counted in items from the file's start."""
    step = max(1, block_bytes // item_bytes)
    spark = files.sparkSession

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = batch.column(0).to_pylist()
            found = []
            for uri in uris:
                with open_range(uri) as file:
                    found.append(file.size())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["file", "bytes"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.to_pylist()):
                with open_range(row["file"]) as file:
                    packed = file.read_at(row["items"] * item_bytes, row["first"] * item_bytes)
                ends = np.flatnonzero(np.frombuffer(packed, f"<u{item_bytes}") == separator) + row["first"]
                # A block of empty documents is all separators: they go to Arrow as they are.
                found = pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends, pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 1).columns, found], names=["file", "block", "first", "items", "ends"])

    sized = files.select("file").mapInArrow(sizes, "file string, bytes long")
    whole = sized.withColumn("n", F.when(F.col("bytes") % item_bytes == 0, F.col("bytes") / item_bytes).otherwise(F.raise_error(F.concat(F.lit("cut item at the end of "), F.col("file")))).cast("long"))
    cut = whole.where("n > 0").withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) DIV {step})")))
    cut = cut.selectExpr("file", "block", f"block * {step} AS first", f"least({step}, n - block * {step}) AS items")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread_out = cut.repartition(parts, "file", "block")
    return spread_out.mapInArrow(search, "file string, block long, first long, items long, ends array<long>")


def scan_token_files(files: DataFrame, separator: int, item_bytes: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document in the token files named by files (file).

    start and n_tokens count items, n_tokens without the separator. Tokens after the last separator
    of a file are one more document, with ended false. Empty files have no documents; a size that
    is no multiple of item_bytes is an error. A task holds one block and its separators.
    """
    blocks = cut_lineage(_blocks(files, separator, item_bytes, block_bytes), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = blocks.selectExpr("file", "block", "first + items AS stop", "size(ends) AS n", "try_element_at(ends, -1) AS last")
    state = state.select("file", "block", "stop", "last", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("seen"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"), "n")
    found = blocks.select("file", "block", "ends").join(state.select("file", "block", "seen", "previous"), ["file", "block"])
    found = found.select("file", "seen", "previous", "ends", F.posexplode("ends").alias("i", "stop"))
    found = found.withColumn("start", F.expr("IF(i = 0, previous, ends[i - 1]) + 1"))
    found = found.selectExpr("file", "seen + i AS ordinal", "start", "stop - start AS n_tokens", "true AS ended")
    rest = state.groupBy("file").agg(F.max("stop").alias("stop"), F.max("last").alias("last"), F.sum("n").alias("ordinal"))
    rest = rest.withColumn("start", F.coalesce("last", F.lit(-1)) + 1).where("start < stop")
    return found.unionByName(rest.selectExpr("file", "ordinal", "start", "stop - start AS n_tokens", "false AS ended"))


def token_counts(docs: DataFrame, tokens: list[bytes], pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, file, ordinal) of every document: written to token files, then counted from the files alone.

    A null text has no tokens; repeated rows are documents of their own; a null id stays null.
    """
    written = write_token_files(docs, tokens, pattern, separator, id_col, text_col)
    counts = scan_token_files(written.select("file").distinct(), separator)
    return written.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
