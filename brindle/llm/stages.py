"""The operators as stages of a pipeline: documents in, documents with the same columns out.

Columns travel inside one struct, so that none clashes with a name used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import language_id, line_dedup, mixing, ngram_join, packing
from .common import squeezed, text_of, word_count


def with_known_language(docs: DataFrame) -> DataFrame:
    """Drops the texts that language ID rejects: without a letter, or null; mixed languages stay. Where no text teaches a
    language, all stay."""
    model = language_id.learn(docs.where(~language_id.held_out()))
    if not model.languages:
        return docs
    label = language_id.labels_of(docs.sparkSession, model, F.col("text"))
    return docs.select(F.struct(*docs.columns).alias("_doc"), label.alias("_label")).where(F.col("_label.lang_pred") != "und").select("_doc.*")


def without_copied_lines(docs: DataFrame) -> DataFrame:
    """Takes later copies of line runs out; a text that consists of them goes. ``n_chars`` follows the text."""
    found = line_dedup.line_dedup(docs.select(F.struct(*docs.columns).alias("_doc"), F.col("doc_id"), F.col("text")))
    found = found.where((F.col("n_removed") == 0) | (word_count(text_of("text")) > 0))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col("_doc.n_chars")).alias(c))
        else:
            columns.append(F.col(f"_doc.`{c}`").alias(c))
    return found.select(*columns)


def without_near_copies(docs: DataFrame) -> DataFrame:
    """Keeps one document of each group of linked texts: that of the smallest id, null last, then of the smallest hash of
    id and text; of rows that repeat both, one. Texts without words are linked with nothing and stay."""
    found = ngram_join.ngram_join(docs, groups=True).where("group IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "row"))
    stay = found.groupBy("group").agg(first.alias("x")).select(F.col("x.row").alias("_stay")).distinct()
    own = docs.select(F.struct(*docs.columns).alias("_doc"), F.xxhash64("doc_id", text_of("text")).alias("_row"), (squeezed(text_of("text")) == "").alias("_blank"))
    kept = own.where("NOT _blank").join(stay, F.col("_row") == F.col("_stay"), "left_semi")
    kept = kept.withColumn("_i", F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(0)))).where("_i = 1")
    return kept.select("_doc.*").unionByName(own.where("_blank").select("_doc.*"))


def mixed(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix_sources(docs, keep=F.struct(*docs.columns)).where("copies > 0")
    return taken.select("kept", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("kept.*")


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs)
