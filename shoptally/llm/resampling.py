"""Importance resampling towards a target distribution, over hashed word n-grams.

Features of a text are its runs of 1 to ``order`` consecutive words, repeats included, each in one of
``BUCKETS`` buckets by the CRC of its bytes.  How often each bucket occurs in the corpus and in the target
gives the bucket's gain, the logarithm of how much likelier the target makes it.  A text's weight is the mean
gain of its features; with Gumbel noise drawn from its id added, the highest scores are a sample without
replacement, likelier where the weight is higher.

Arrow kernels take a batch of texts apart (ascii_lower, split_pattern_regex and list_flatten in ``split_words``) and number its
distinct words (dictionary_encode); shifted indices form n-grams, only distinct ones are hashed, and gains are
taken by index and summed per text.  Both passes read the texts and shuffle none; between them the
driver holds one number per bucket.  The threshold comes from a histogram of scores, which are whole numbers in a
range that logarithms bound (under 100,000 values), and only rows at or above it are sorted.

Defined cases: a null or empty text has no features, weight 0, and is never drawn (fewer than ``MIN_WORDS``
words).  A null id draws its noise as ''.  Equal rows score alike; ties go to the smaller id (null
last), of rows equal in both any may be drawn.  An empty corpus gives an empty table, an empty target only
smoothed counts.  Other columns are not touched; added ones start with ``_r_``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shoptally.llm.storage import saved
from shoptally.llm.words import SEPARATORS, slices, split_words
from shoptally.operators.ordering import with_position

BUCKETS = 10_000
ORDER = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
SCALE = 1000
TEXT_BYTES = 8 << 20


def features(texts: pa.Array, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 to ``order``: bucket of each distinct n-gram, which of them stands where, and its text's row."""
    flat, row = split_words(texts)
    words = flat.dictionary_encode()
    index = words.indices.to_numpy().astype(np.int64)
    spelt = words.dictionary.cast(pa.large_binary()).to_pylist()
    # Separators at either end of a text leave an empty word.
    there = index != spelt.index(b"") if b"" in spelt else np.ones(len(index), bool)
    index, row = index[there], row[there]
    crc = np.array([zlib.crc32(w) for w in spelt], np.int64)
    gram, at = index, np.arange(len(index))
    for n in range(1, order + 1):
        if n > 1:
            # Each (n-1)-gram with the word after it, where that is in the same text.
            follows = at + n - 1 < len(index)
            follows[follows] = row[at[follows]] == row[at[follows] + n - 1]
            at, gram = at[follows], gram[follows]
            pairs, gram = np.unique(gram * len(spelt) + index[at + n - 1], return_inverse=True)
            begun = crc[pairs // max(len(spelt), 1)].tolist()
            last = (pairs % max(len(spelt), 1)).tolist()
            crc = np.array([zlib.crc32(b" " + spelt[w], c) for c, w in zip(begun, last, strict=True)], np.int64)
        yield crc % BUCKETS, gram, row[at]


def bucket_counts(texts: DataFrame, order: int = ORDER) -> np.ndarray:
    """How many features of the column ``text`` are in each bucket: one table per task, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text", TEXT_BYTES):
            for bucket, gram, _ in features(batch.column("text"), order):
                per_gram = np.bincount(gram, minlength=len(bucket))
                total += np.bincount(bucket, weights=per_gram, minlength=BUCKETS).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    counted = texts.select("text").mapInArrow(count, "bucket int, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds: the scaled logarithm of its likelihood ratio, rounded down."""
    in_corpus, in_target = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    counts = zip(corpus.tolist(), target.tolist(), strict=True)
    ratios = [((t + 1) * in_corpus) / ((s + 1) * in_target) for s, t in counts]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: Column) -> Column:
    """Gumbel noise from the id: eight hexadecimal digits of a hash as a number between 0 and 1."""
    spelt = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(spelt, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-float(SCALE) * F.log(-F.log((drawn + 0.5) / float(1 << 32)))).cast("long")


def weighed(docs: DataFrame, target: DataFrame, order: int = ORDER) -> DataFrame:
    """The rows of ``docs`` with ``_r_words``, ``_r_features``, ``_r_weight`` and ``_r_score``."""
    table = docs.sparkSession.sparkContext.broadcast(
        gains(bucket_counts(docs, order), bucket_counts(target, order))
    )
    added = ["_r_words", "_r_features", "_r_weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            number, gained, words = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), None
            for bucket, gram, row in features(batch.column("text"), order):
                ends = np.cumsum(per_row := np.bincount(row, minlength=len(batch)))
                sums = np.append(0, np.cumsum(table.value[bucket][gram]))
                words = per_row if words is None else words
                number += per_row
                gained += sums[ends] - sums[ends - per_row]
            weight = np.where(number > 0, gained // np.maximum(number, 1), 0)
            columns = [*batch.columns, pa.array(words.astype(np.int64)), pa.array(number), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    names = docs.columns
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in added)])
    return docs.mapInArrow(weigh, schema).withColumn("_r_score", F.col("_r_weight") + noise(F.col("doc_id")))


def ranked(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Add ``_r_rank`` to weighed rows, from 1; null where a row is not drawn."""
    enough = F.col("_r_words") >= MIN_WORDS
    histogram = rows.where(enough).groupBy("_r_score").agg(F.count(F.lit(1)).alias("n")).collect()
    drawn = percent * sum(r["n"] for r in histogram) // 100
    lowest, left = None, drawn
    for r in sorted(histogram, key=lambda r: -r["_r_score"]):
        if left <= 0:
            break
        lowest, left = r["_r_score"], left - r["n"]
    may = F.lit(False) if lowest is None else enough & (F.col("_r_score") >= lowest)
    placed = with_position(rows.where(may), [F.col("_r_score").desc(), F.col("doc_id").asc_nulls_last()], "_r_place")
    top = placed.withColumn("_r_rank", F.when(F.col("_r_place") <= drawn, F.col("_r_place"))).drop("_r_place")
    return top.unionByName(rows.where(~may).withColumn("_r_rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, order: int = ORDER) -> DataFrame:
    """The rows of ``docs`` that are drawn towards the texts of ``target``, with the input's columns."""
    drawn = ranked(saved(weighed(docs, target, order)), percent).where(F.col("_r_rank").isNotNull())
    return drawn.select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row."""
    rows = weighed(docs.select("doc_id", "text"), target).drop("text")
    return ranked(saved(rows)).select(
        "doc_id",
        F.col("_r_features").alias("n_features"),
        F.col("_r_weight").alias("weight"),
        F.col("_r_score").alias("score"),
        F.col("_r_rank").alias("rank"),
    )


def crc32_sql(word: str, table: str) -> str:
    """CRC of a string's UTF-8 bytes in DuckDB SQL; ``table`` is the list of the 256 steps."""
    byte = f"('0x' || substr(hex({word}), 2 * i + 1, 2))::BIGINT"
    bytes_ = f"list_transform(range(strlen({word})), lambda i: {byte})"
    step = f"xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: {step}))"


CRC_STEPS_SQL = """SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS r(i)"""


def report_sql() -> str:
    """The same report in DuckDB SQL, one row per word."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = f"translate(coalesce(text, ''), '{capitals}', '{small}')"
    words = f"list_filter(string_split_regex({lowered}, '{SEPARATORS}'), lambda w: w <> '')"
    return f"""
WITH k AS ({CRC_STEPS_SQL}),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS ws FROM documents),
b AS (SELECT {words} AS ws FROM benchmark),
w AS (SELECT rid, unnest(ws) AS word FROM d),
y AS (SELECT unnest(ws) AS word FROM b),
v AS (SELECT word, {crc32_sql('word', 'steps')} % {BUCKETS} AS bucket
      FROM (SELECT word FROM w UNION SELECT word FROM y) u, k),
s AS (SELECT bucket, count(*) AS s FROM w JOIN v USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM y JOIN v USING (word) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM w) AS ns, (SELECT count(*) FROM y) AS nt),
g AS (SELECT s.bucket, CAST(floor({SCALE} * ln(CAST((coalesce(t, 0) + 1) * (ns + {BUCKETS}) AS DOUBLE)
        / CAST((s + 1) * (nt + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), n),
m AS (SELECT rid, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS gained
      FROM w JOIN v USING (word) JOIN g USING (bucket) GROUP BY rid),
e AS (SELECT d.rid, doc_id, coalesce(n_features, 0) AS n_features,
        coalesce((gained - ((gained % n_features) + n_features) % n_features) // n_features, 0) AS weight,
        ('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
      FROM d LEFT JOIN m USING (rid)),
f AS (SELECT *, weight + CAST(floor(-{SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS place,
        {PERCENT} * count(*) OVER () // 100 AS drawn FROM f WHERE n_features >= {MIN_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN place <= drawn THEN place END AS BIGINT) AS rank FROM f LEFT JOIN r USING (rid)"""
