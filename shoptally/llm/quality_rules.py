"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

``RULES`` names, for each rule, an upper or lower bound on the ratio of two counted columns.  The
bounds are fractions of integers, so that no verdict depends on rounding.  ``measure`` counts,
``verdicts`` compiles the table; both only add columns, and no row is moved.

Defined cases: a null or empty text has no words, all its counts are 0 and it fails the base rule
(fewer than 20 words).  Rows are judged one by one: repeated rows and rows with null keys get the
same verdict each.  An empty table gives an empty table.  Counted columns start with ``_q_`` and never
clash with columns of the input unless these have that prefix; the input's columns are returned as
they are.  Two windows of one text are held equal by a 64-bit hash of their eight words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as at this by are an from or have not you "
    "der die das und ist nicht ein eine zu den von mit sich des auf für dem im als auch "
    "le la les un une et est en que qui dans pour pas sur au du par plus de "
    "el los las y es por con para del se lo su al más como"
).split()
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})


@dataclass(frozen=True)
class Rule:
    """A row fails if count * over > limit * base (or < where ``below``)."""

    count: str
    over: int
    limit: int
    base: str
    below: bool = False

    def failed(self) -> Column:
        left, right = F.col(f"_q_{self.count}") * self.over, F.col(f"_q_{self.base}") * self.limit
        return left < right if self.below else left > right


BASE_RULES = (
    Rule("words", 1, MIN_WORDS, "one", below=True),
    Rule("repeat_words", 100, 30, "words"),
)
RULES = (
    Rule("symbols", 10, 3, "words"),
    Rule("dup_lines", 2, 1, "lines"),
    Rule("word_chars", 1, 2, "words", below=True),
    Rule("word_chars", 1, 15, "words"),
    Rule("stop_words", 100, 1, "words", below=True),
)


def _paired(name: str, step: int, x: Column, i: Column) -> Column:
    return F.xxhash64(x, F.get(F.col(name), i + step))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules compare, all as long, under the prefix ``_q_``."""
    kept = docs.columns
    words = F.filter(F.split(F.col("_q_text"), SPACES), lambda w: w != "")
    lines = F.filter(F.split(F.col("_q_text"), "\n"), lambda x: x.rlike(NOT_SPACE))
    cut = docs.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    cut = cut.withColumns({"_q_w": words, "_q_l": lines})
    # Hashes of one, two, four and eight words; the last seven positions start no window.
    cut = cut.withColumn("_q_h1", F.transform("_q_w", lambda w: F.xxhash64(w)))
    for k in (1, 2, 4):
        h = f"_q_h{k}"
        cut = cut.withColumn(f"_q_h{2 * k}", F.transform(h, partial(_paired, h, k)))
    counted = cut.withColumns(
        {
            "_q_one": F.lit(1),
            "_q_words": F.size("_q_w").cast("long"),
            "_q_word_chars": F.length(F.array_join("_q_w", "")).cast("long"),
            "_q_symbols": F.regexp_count("_q_text", F.lit(SYMBOLS)).cast("long"),
            "_q_lines": F.size("_q_l").cast("long"),
            "_q_dup_lines": (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("long"),
            "_q_stop_words": F.size(F.filter("_q_w", lambda w: w.isin(STOP_FORMS))).cast("long"),
            "_q_h": F.slice("_q_h8", 1, F.greatest(F.size("_q_w") - (WINDOW - 1), F.lit(0))),
        }
    )
    # Most texts repeat no window, and only the others are sorted.
    found = counted.withColumn("_q_twice", F.size(F.array_distinct("_q_h")) < F.size("_q_h"))
    found = found.withColumn(
        "_q_s",
        F.when(
            F.col("_q_twice"),
            F.sort_array(F.transform("_q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    equal = lambda x, j: F.coalesce(F.get(F.col("_q_s"), j)["h"] == x["h"], F.lit(False))
    found = found.withColumn(
        "_q_p",
        F.when(
            F.col("_q_twice"),
            F.sort_array(
                F.transform(
                    F.filter("_q_s", lambda x, j: equal(x, j - 1) | equal(x, j + 1)), lambda x: x["i"]
                )
            ),
        ),
    )
    covered = F.aggregate(
        F.transform(
            "_q_p",
            lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_q_p"), j + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    found = found.withColumn(
        "_q_repeat_words", F.when(F.col("_q_twice"), covered).otherwise(0).cast("long")
    )
    counts = [r for r in found.columns if r.startswith("_q_") and r not in SCRATCH]
    return found.select(*(F.col(f"`{c}`") for c in kept), *counts)


SCRATCH = ("_q_text", "_q_w", "_q_h1", "_q_h2", "_q_h4", "_q_h8", "_q_l", "_q_h", "_q_twice", "_q_s", "_q_p")


def verdicts(measured: DataFrame) -> DataFrame:
    """Add ``_q_base_failed`` and ``_q_kept``: the table as one projection."""
    any_of = lambda rules: F.greatest(*(r.failed() for r in rules))
    out = measured.withColumn("_q_base_failed", any_of(BASE_RULES))
    return out.withColumn("_q_kept", ~(F.col("_q_base_failed") | any_of(RULES)))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass every rule, with the input's columns."""
    # A plain filter would be pushed below the projections, which repeats every count in each place
    # that uses it; it is not pushed below a column with a random part.
    kept = (F.rand(0) + F.col("_q_kept").cast("int")) >= 1
    judged = verdicts(measure(docs, text)).withColumn("_q_stays", kept)
    return judged.where("_q_stays").select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the counts and both verdicts."""
    judged = verdicts(measure(docs.select("doc_id", "text")))
    names = ("word_chars", "symbols", "dup_lines", "repeat_words")
    return judged.select(
        "doc_id",
        F.col("_q_words").alias("n_words"),
        *(F.col(f"_q_{x}").alias(x if x == "word_chars" else f"n_{x}") for x in names),
        F.col("_q_base_failed").alias("base_failed"),
        F.col("_q_kept").alias("kept"),
    )


def report_sql() -> str:
    """The same report in DuckDB SQL, by another way: one row per word and window functions."""
    stop = ", ".join(f"'{w}'" for w in STOP_FORMS)

    def fails(rules: tuple[Rule, ...]) -> str:
        return " OR ".join(
            f"{r.count} * {r.over} {'<' if r.below else '>'} {r.base} * {r.limit}" for r in rules
        )

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS symbols FROM d),
w AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM s),
g AS (SELECT rid, pos, count(*) OVER eight AS n, string_agg(word, ' ') OVER eight AS gram FROM w
      WINDOW eight AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
r AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, gram) > 1 AS twice FROM g WHERE n = 8),
c AS (SELECT w.rid, count(*) AS words, sum(length(word)) AS word_chars,
        sum(CASE WHEN word IN ({stop}) THEN 1 ELSE 0 END) AS stop_words,
        sum(CASE WHEN seen THEN 1 ELSE 0 END) AS repeat_words
      FROM (SELECT w.rid, w.pos, w.word, coalesce(bool_or(r.twice) OVER (PARTITION BY w.rid ORDER BY w.pos
                ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), false) AS seen
            FROM w LEFT JOIN r ON w.rid = r.rid AND w.pos = r.pos) w GROUP BY w.rid),
m AS (SELECT doc_id, 1 AS one, coalesce(words, 0) AS words, coalesce(word_chars, 0) AS word_chars, symbols,
        len(ls) AS lines, len(ls) - len(list_distinct(ls)) AS dup_lines, coalesce(stop_words, 0) AS stop_words,
        coalesce(repeat_words, 0) AS repeat_words
      FROM d JOIN s USING (rid) LEFT JOIN c USING (rid))
SELECT doc_id, CAST(words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(symbols AS BIGINT) AS n_symbols, CAST(dup_lines AS BIGINT) AS n_dup_lines,
  CAST(repeat_words AS BIGINT) AS n_repeat_words, ({fails(BASE_RULES)}) AS base_failed,
  NOT ({fails(BASE_RULES + RULES)}) AS kept FROM m"""
