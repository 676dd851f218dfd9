"""Quality rules by a bitmask ledger.

Every rule is evaluated once per text, in one pass over its bytes. The ledger stores what
was measured and one failure bit per rule. A policy is a version name and a mask of the
rules it enforces: verdicts, later policies and ablations read the narrow ledger only.

Edge cases: a null text has no words and measures 0 everywhere. An empty table gives an
empty ledger. Repeated rows and null ids are kept, each row by itself. Only the id and the
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.llm.words import (NOT_SPACE, byte_class, chunks, count_between, hash_spans, of_row, windows, words)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
WINDOW = 8
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = byte_class([(65, 90)])


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures, in whole numbers, so that it is exact anywhere."""

    name: str
    fails: str
    base: bool = False


RULES = (
    Rule("few_words", "n_words < 20", base=True),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words", base=True),
    Rule("symbols", "100 * n_symbols > 5 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("upper_case", "100 * n_upper > 50 * word_chars"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
BASE_MASK = sum(BIT[rule.name] for rule in RULES if rule.base)
#: Version name to the rules enforced; versions are never changed, only added.
POLICIES = {"v1": BASE_MASK, "v2": sum(BIT.values())}
POLICY = "v2"


def _measure(texts: pa.Array) -> np.ndarray:
    """One row of MEASURES per text of a small batch."""
    found = words(texts, NOT_SPACE, lower=False)
    data, offsets, n = found.data, found.offsets, len(texts)
    out = np.zeros((n, len(MEASURES)), np.int64)
    if not len(data):
        return out
    flags = NOT_SPACE[data]
    out[:, 0] = np.diff(found.bounds)
    out[:, 1] = count_between(flags & ((data & 0xC0) != 0x80), offsets)
    out[:, 2] = count_between(_SYMBOLS[data], offsets)
    out[:, 6] = count_between(_UPPER[data], offsets)

    # Lines that hold a word: a line is cut at \n and where a text begins or ends.
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    starts.sort()
    ends.sort()
    total = np.concatenate([[0], np.cumsum(flags)])
    real = total[ends] > total[starts]
    starts, ends = starts[real], ends[real]
    rows = np.searchsorted(offsets, starts, "right") - 1
    out[:, 3] = np.bincount(rows, minlength=n)
    keys = np.unique(of_row(hash_spans(data, starts, ends), rows), return_index=True)[1]
    out[:, 4] = out[:, 3] - np.bincount(rows[keys], minlength=n)

    # Words in windows that occur twice or more in their text.
    hashes, first = windows(found, WINDOW)
    if len(first):
        by_word = found.rows()
        _, which, times = np.unique(of_row(hashes, by_word[first]), return_inverse=True, return_counts=True)
        hit = first[times[which] > 1]
        cover = np.zeros(len(by_word) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.subtract.at(cover, hit + WINDOW, 1)
        out[:, 5] = np.bincount(by_word[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def measures(text: Column) -> Column:
    """The measures of a text, as a struct of longs."""

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_measure(part) for _, part in chunks(texts)]
        found = np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)), np.int64)
        return pa.StructArray.from_arrays([pa.array(found[:, j]) for j in range(len(MEASURES))], names=list(MEASURES))

    return measure(text)


def failure_bits(measured: str = "") -> Column:
    """The failure bits, from columns (or fields of the struct ``measured``) named as MEASURES."""
    field = re.compile(r"\b(" + "|".join(MEASURES) + r")\b")
    bits = []
    for rule in RULES:
        fails = field.sub(rf"{measured}.\1", rule.fails) if measured else rule.fails
        bits.append(F.when(F.expr(fails), F.lit(BIT[rule.name])).otherwise(F.lit(0)))
    return sum(bits[1:], bits[0]).cast("int")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measures and ``bits`` for each row."""
    measured = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    return measured.select("doc_id", "m.*").withColumn("bits", failure_bits())


def apply_policy(of: DataFrame, version: str = POLICY) -> DataFrame:
    """The ledger with ``failed_bits`` (those the policy enforces) and ``kept``."""
    enforced = F.col("bits").bitwiseAND(F.lit(POLICIES[version]))
    return of.withColumns({"policy": F.lit(version), "failed_bits": enforced, "kept": enforced == 0})


def ablations(of: DataFrame, version: str = POLICY) -> DataFrame:
    """Per rule of a policy: rows that fail it, that fail it alone, and kept rows without it.

    One count per bit pattern (at most 2 to the number of rules) is all that is shuffled;
    the rest is bitwise arithmetic on those patterns.
    """
    patterns = of.groupBy(F.col("bits").bitwiseAND(F.lit(POLICIES[version])).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).alias("bit"))
                      for r in RULES if POLICIES[version] & BIT[r.name]])
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    total = lambda condition: F.sum(F.when(condition, F.col("count")).otherwise(0))
    return patterns.select("bits", "count", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        total(fails).alias("failing"), total(fails & (others == 0)).alias("failing_alone"),
        total(others == 0).alias("kept_without"))


def keep_good(docs: DataFrame, version: str = POLICY, text_col: str = "text") -> DataFrame:
    """The rows that a policy keeps, with the columns they came with."""
    bits = failure_bits("__measured").bitwiseAND(F.lit(POLICIES[version]))
    return (docs.withColumn("__measured", measures(F.col(text_col))).filter(bits == 0).select(*docs.columns))


SQL_MEASURES = """
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
positions AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM split),
grams AS (
  SELECT doc_id, i, list(w) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM positions),
twice AS (
  SELECT doc_id, i FROM grams WHERE len(g) = 8
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) r(k) GROUP BY 1),
measured AS (
  SELECT s.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM split s LEFT JOIN covered c USING (doc_id))"""
_SQL_FAILS = {r.name: f"({r.fails})" for r in RULES}
SQL = f"""WITH {SQL_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {' OR '.join(_SQL_FAILS[r.name] for r in RULES if r.base)} AS base_failed,
       NOT ({' OR '.join(_SQL_FAILS[r.name] for r in RULES if POLICIES[POLICY] & BIT[r.name])}) AS kept,
       ({' + '.join(f"CASE WHEN {_SQL_FAILS[r.name]} THEN {BIT[r.name]} ELSE 0 END" for r in RULES)})::INTEGER AS bits
FROM measured"""


@query(SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base_failed = F.col("bits").bitwiseAND(F.lit(BASE_MASK)) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"), "bits")
