"""Mix sources to target weights with Efraimidis-Spirakis keys.

Sources in code point order (null last) weigh 1, 2, 3, repeating, and share the corpus's words; a
target stops at ``MAX_EPOCHS`` times the source's size and the excess is shared out by weight until
no target is above.  A source is then taken in complete epochs, and what is left of its target by
a weighted sample without replacement: every document gets the key -ln(u) / w, with u drawn from
its id by a hash and w its quality weight, and documents are taken in the order of their keys
until the words are used up.  The last one is taken if that comes nearer to the target.

The prefix sums over a source are taken in two steps, so that no task sees a whole source: words
are summed per (source, slice of the key range) first, which says where each slice begins, and
only inside a slice are documents ordered.  Slices are a fixed fraction of a source.

Defined cases: a null or empty text has size 0 and is taken 0 times (it is part of complete
epochs, which adds nothing).  A null source is a source of its own.  Rows with equal ids have equal
keys; they are ordered by a hash of the text, and rows equal in both are interchangeable.  A null
id is hashed as the text ''.  A source without words has target 0.  An empty table gives an empty table.
Columns of the input other than doc_id, text and source are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptally.llm.storage import saved

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SLICES = 4096
SEED = "mix-1"
SYMBOLS = "[#*$%&|<>]"


def _draw(doc_id: Column) -> Column:
    """u in (0, 1) from the id: 48 bits of a hash that every SQL engine has."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(hexed, 16, 10).cast("double") + 0.5) / float(1 << 48)


def _quality(text: Column) -> Column:
    """Weight from 1 (no symbols) down to 0.25 (half the characters or more)."""
    symbols = F.regexp_count(text, F.lit(SYMBOLS))
    return 1.0 - F.lit(0.75) * F.least(
        F.lit(1.0), 2.0 * symbols.cast("double") / F.greatest(F.length(text), F.lit(1)).cast("double")
    )


def keyed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, source, size in words, key, a slice of the key range, tie breaker."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = -F.log(_draw(F.col("doc_id"))) / _quality(text)
    out = docs.select(
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        key.alias("es_key"),
        F.xxhash64(text).alias("tie"),
    )
    return out.withColumn("slice", F.least(F.lit(SLICES - 1), F.floor(SLICES * (1 - F.exp(-F.col("es_key"))))).cast("int"))


def targets(sizes: DataFrame) -> DataFrame:
    """Targets from (source, source_size), one row per source.

    With sources sorted by 3 * size / weight, those that stop at their bound come first; the level
    of the others is what is left over their weights.  The rows are one per source, not one per
    document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (position + 1).cast("int"))
    bound = F.lit(float(MAX_EPOCHS)) * F.col("source_size")
    every = Window.partitionBy()
    ranked = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumns({"weight": weight, "bound": bound}).withColumn("ratio", F.col("bound") / F.col("weight"))
    rows = rows.withColumns(
        {
            "total": F.sum("source_size").over(every).cast("double"),
            "held": F.coalesce(F.sum("bound").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "place": F.row_number().over(ranked),
        }
    )
    rows = rows.withColumn("level", (F.col("total") - F.col("held")) / F.col("open_weight"))
    # The first source whose own bound is not below its level sets the level of all that follow.
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(every)["level"]
    return rows.withColumn("shared", level).select(
        "source",
        "source_size",
        F.when(F.col("shared").isNull(), F.col("bound"))
        .otherwise(F.least(F.col("bound"), F.col("shared") * F.col("weight")))
        .alias("target"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words) and repeats, with source, key and tie."""
    rows = saved(keyed(docs))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    goals = targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")))
    in_source = Window.partitionBy("source").orderBy("slice")
    starts = slices.withColumn("slice_start", F.sum("slice_size").over(in_source) - F.col("slice_size")).alias("s")
    parts = starts.join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        F.col("s.source").alias("source"), F.col("s.slice").alias("slice"), "slice_start", "source_size", "target"
    )
    joined = rows.alias("d").join(
        parts.alias("p"),
        (F.col("d.slice") == F.col("p.slice")) & F.col("d.source").eqNullSafe(F.col("p.source")),
    )
    joined = joined.select("d.*", "slice_start", "source_size", "target")
    in_slice = (
        Window.partitionBy("source", "slice")
        .orderBy("es_key", F.col("doc_id").asc_nulls_last(), "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    before = F.col("slice_start") + F.coalesce(F.sum("size").over(in_slice), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = (2 * F.col("before") + F.col("size") <= 2 * rest).cast("long")
    out = joined.withColumns({"epochs": epochs.cast("long"), "before": before})
    return out.withColumn("repeats", F.col("epochs") + F.when(rest > 0, more).otherwise(0)).withColumn(
        "taken", F.col("repeats") * F.col("size")
    )


def report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", "repeats"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the input's rows, each as often as it is taken."""
    marked = docs.withColumn("_m_tie", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    plan = mix(docs).groupBy("doc_id", "source", "tie").agg(F.min("repeats").alias("_m_repeats"), F.sum("repeats").alias("_m_all"), F.count(F.lit(1)).alias("_m_rows"))
    plan = plan.select(
        F.col("doc_id").alias("_m_id"), F.col("source").alias("_m_source"), F.col("tie").alias("_m_key"), "_m_repeats",
        (F.col("_m_all") - F.col("_m_repeats") * F.col("_m_rows")).alias("_m_extra"),
    )
    joined = marked.join(
        plan,
        (F.col("_m_tie") == F.col("_m_key"))
        & F.col("doc_id").eqNullSafe(F.col("_m_id"))
        & F.col("source").eqNullSafe(F.col("_m_source")),
    )
    # Of rows equal in id, source and text some may be taken once more than the others.
    same = Window.partitionBy("doc_id", "source", "_m_tie").orderBy(F.lit(1))
    times = F.col("_m_repeats") + (F.row_number().over(same) <= F.col("_m_extra")).cast("long")
    taken = joined.withColumn("_m_times", times).where("_m_times > 0")
    return taken.withColumn("_m_copy", F.explode(F.sequence(F.lit(1), F.col("_m_times")))).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )


def report_sql() -> str:
    """The same mix in DuckDB SQL with one plain prefix sum per source."""
    weights = ", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, source, t, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS size,
        (('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT + 0.5::DOUBLE)
          / {1 << 48}::DOUBLE AS u,
        1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, 2.0::DOUBLE
          * CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS DOUBLE)
          / CAST(greatest(length(t), 1) AS DOUBLE)) AS w FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
o AS (SELECT *, [{weights}][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight FROM s),
b AS (SELECT *, {MAX_EPOCHS}.0::DOUBLE * source_size AS bound FROM o),
l AS (SELECT a.source, (SELECT sum(source_size) FROM b) - coalesce(sum(c.bound) FILTER (c.bound / c.weight < a.bound / a.weight), 0) AS rest,
        sum(c.weight) FILTER (c.bound / c.weight >= a.bound / a.weight) AS open_weight, any_value(a.bound / a.weight) AS ratio
      FROM b a CROSS JOIN b c GROUP BY a.source),
v AS (SELECT min(rest / open_weight) AS level FROM l
      WHERE ratio = (SELECT min(ratio) FROM l WHERE ratio >= rest / open_weight)),
g AS (SELECT source, source_size, CASE WHEN level IS NULL THEN bound ELSE least(bound, level * weight) END AS target FROM b, v),
e AS (SELECT k.doc_id, k.size, g.source_size, g.target,
        CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY -ln(u) / w, doc_id, t
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
f AS (SELECT *, target - epochs * source_size AS rest FROM e),
r AS (SELECT *, epochs + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END AS repeats FROM f)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(repeats * size AS BIGINT) AS taken,
  CAST(repeats AS BIGINT) AS repeats FROM r"""
