"""Token counts of flat token files by a scan for separators.

A flat file is a run of 16-bit token ids in which an end-of-document id closes each document; nothing
says where documents begin.  The file is read in blocks that ignore documents.  In each block numpy
finds all separators at once, which gives the lengths of the documents that lie inside; what a
block leaves open at its ends is stitched by a prefix scan over the blocks of the file: a running count
of separators numbers the documents, and a running maximum of the last separator's place gives the tokens
that the document closed first in a block has in earlier ones.

``flat_blocks`` writes documents as such files (one per input partition, in blocks) with the order
of their ids, ``read_flat_files`` reads files that others wrote, ``documents_in`` scans either.

Defined cases: a null or empty text has 0 tokens (its separator alone).  The separator's string inside a
text is ordinary text.  Tokens after the last separator are one more document, marked as not closed.
Equal rows are counted each; a null id stays null.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoptally.llm.storage import saved
from shoptally.llm.words import slices

SEPARATOR = 50256
BLOCK_TOKENS = 1 << 16
_BLOCKS = "file string, block long, data binary"


def _encoder(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def flat_blocks(docs: DataFrame, vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, data) of the documents' tokens, and rows (file, block, ids) with a null ``data``.

    The latter list the ids in the order of the documents; ``block`` is the place of the first one.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = _encoder(vocabulary), f"part-{TaskContext.get().partitionId():06d}"
        end, rest, block, place = np.array([SEPARATOR], np.uint32), np.zeros(0, "<u2"), 0, 0

        def rows(numbers: list[int], data: list[bytes | None], ids: pa.Array) -> pa.RecordBatch:
            columns = [pa.array([file] * len(numbers)), pa.array(numbers, pa.int64()), pa.array(data, pa.binary()), ids]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "data", "ids"])

        for batch in slices(batches, "text"):
            doc_ids = batch.column("doc_id")
            parts = [rest]
            for text in batch.column("text").fill_null("").to_pylist():
                parts += [encoder.encode_to_numpy(text, disallowed_special=()), end]
            tokens = np.concatenate(parts).astype("<u2")
            full = len(tokens) // block_tokens * block_tokens
            cut = [tokens[i : i + block_tokens].tobytes() for i in range(0, full, block_tokens)]
            rest = tokens[full:]
            none = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
            yield rows([place], [None], none)
            if cut:
                yield rows(list(range(block, block + len(cut))), cut, pa.nulls(len(cut), pa.list_(doc_ids.type)))
            block, place = block + len(cut), place + len(doc_ids)
            id_list = pa.list_(doc_ids.type)
        if len(rest):
            yield rows([block], [rest.tobytes()], pa.nulls(1, id_list))

    return docs.select("doc_id", "text").mapInArrow(write, f"{_BLOCKS}, ids array<{id_type}>")


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, data) of files of 16-bit little-endian ids under ``path``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                for block, at in enumerate(range(0, len(data), 2 * block_tokens)):
                    columns = [pa.array([name]), pa.array([block], pa.int64()), pa.array([bytes(data[at : at + 2 * block_tokens])])]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "data"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(cut, _BLOCKS)


def scan_blocks(blocks: DataFrame) -> DataFrame:
    """Per block: tokens, separators, tokens before the first and after the last one, lengths between.

    Rows without data pass through with their other columns.
    """
    more = [f for f in blocks.schema.fields if f.name not in ("file", "block", "data")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"tokens": [], "separators": [], "head": [], "tail": [], "inner": []}
            for data in batch.column("data"):
                if not data.is_valid:
                    for values in out.values():
                        values.append(None)
                    continue
                ids = np.frombuffer(data.as_buffer(), "<u2")
                at = np.flatnonzero(ids == SEPARATOR)
                out["tokens"].append(len(ids))
                out["separators"].append(len(at))
                out["head"].append(int(at[0]) if len(at) else len(ids))
                out["tail"].append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
                out["inner"].append(np.diff(at) - 1)
            columns = [batch.column("file"), batch.column("block")]
            columns += [pa.array(out[k], pa.int64()) for k in ("tokens", "separators", "head", "tail")]
            columns.append(pa.array(out["inner"], pa.list_(pa.int64())))
            columns += [batch.column(f.name) for f in more]
            names = ["file", "block", "tokens", "separators", "head", "tail", "inner", *(f.name for f in more)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in more)
    counts = "tokens long, separators long, head long, tail long, inner array<long>"
    return blocks.mapInArrow(scan, f"file string, block long, {counts}{extra}")


def _stitched(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens, closed) of every document, from the scans of all blocks."""
    # The prefix scan sees six numbers per block; the lists of lengths are joined to it afterwards.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = scanned.select("file", "block", "tokens", "separators", "head", "tail").withColumn(
        "end", F.sum("tokens").over(ends)
    )
    last = F.when(F.col("separators") > 0, F.col("end") - F.col("tail"))
    prefix = narrow.select(
        "file",
        "block",
        "separators",
        "head",
        F.coalesce(F.sum("separators").over(before), F.lit(0)).alias("first"),
        (F.col("end") - F.col("tokens") - F.coalesce(F.max(last).over(before), F.lit(0))).alias("carried"),
        (F.col("end") - F.coalesce(F.max(last).over(ends), F.lit(0))).alias("open"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("is_last"),
    )
    joined = prefix.join(scanned.select("file", "block", "inner"), ["file", "block"])
    closed = joined.where("separators > 0").select(
        "file",
        "first",
        F.posexplode(F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner"))).alias("k", "n_tokens"),
    )
    closed = closed.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    rest = prefix.where("is_last AND open > 0").select(
        "file", (F.col("first") + F.col("separators")).alias("ordinal"), F.col("open").alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionAll(rest)


def documents_in(blocks: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens, closed) of every document in the files."""
    return _stitched(saved(scan_blocks(blocks)))


def report(docs: DataFrame, vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_tokens of every document, counted in the flat files that hold them."""
    scanned = saved(scan_blocks(flat_blocks(docs, vocabulary, block_tokens)))
    counted = _stitched(scanned.where("tokens IS NOT NULL").drop("ids"))
    order = scanned.where("tokens IS NULL").select("file", "block", F.posexplode("ids").alias("k", "doc_id"))
    order = order.select("file", (F.col("block") + F.col("k")).alias("ordinal"), "doc_id")
    return order.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
