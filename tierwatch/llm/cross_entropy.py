"""Cross-entropy difference of two matched n-gram models over one shared vocabulary.

The score of a document is the mean over its tokens of the target model's loss minus the
background model's, in nats; the lower, the more it is like the target. Models, counts and
their ways through Spark are those of ``word_models``.

The target are the documents that a table of ids names. It grows with the corpus, so it is never broadcast:
texts and ids are shuffled once for that join, without sorting the texts; adaptive execution splits hot ids.

Edge cases: a null or empty text has one token, its end; repeated rows and null ids are kept,
each row by itself; repeated ids of the target name a document once; without target rows the target model is
uniform; an empty table gives an empty result; only the id and the text are read, so other columns cannot clash. A
very long text is a chunk of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.llm.word_models import score_rows


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, difference`` of all rows; all of them are the background."""
    named = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("named")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return score_rows(texts.join(named.hint("shuffle_hash"), F.col("id") == F.col("named"), "left").select(
        "id", "text", F.col("named").isNotNull().cast("int").alias("target"), F.lit(1).alias("background"), F.lit(True).alias("scored")))


@query()
def op1_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against a target of those labelled as good."""
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)
