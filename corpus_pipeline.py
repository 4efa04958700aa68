"""Documents to packed training sequences, in five stages.

Each stage gets the rows that the one before kept, as a table. All but the last
return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import exact_dedup, language, near_dedup, packing, repeats
from isotherm.llm.frames import stored, table

#: A text goes if its windows' likeliest languages have less than this probability on average, or if it has no letter.
LEAST_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a known language; the network learns from the labelled rows of ``docs``."""
    return language.keep_known(docs, language.train(docs), LEAST_LANGUAGE_SCORE)


def _chosen(docs: DataFrame, kept: DataFrame, doc_id: Column, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``docs`` named in ``kept`` (``kept_id, kept_text, alone``); an id alone may be shared by several texts.

    Where not ``alone``, rows that share id and text are one: the least by its columns in their order.
    """
    kept, text = stored(kept, "chosen"), digest(F.coalesce(docs["text"], F.lit("")))

    def rows(named: DataFrame) -> DataFrame:
        return docs.join(named, doc_id.eqNullSafe(named["kept_id"]) & (text == named["kept_text"]), "left_semi")

    several = rows(kept.where("NOT alone")).groupBy(doc_id.alias("kept_id"), text.alias("kept_text"))
    least = several.agg(F.min(F.struct(*docs.columns)).alias("least")).select("least.*")
    return rows(kept.where("alone")).union(least)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    found = exact_dedup.exact_dedup(docs).where("kept")
    kept = found.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text"), (F.col("group_size") == 1).alias("alone"))
    return _chosen(docs, kept, docs["doc_id"], lambda x: F.sha2(x, 256))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by similar sets of five-word shingles; the texts without words are no copies of each other."""
    kept = near_dedup.stand_ins(docs, words=5, similarity=80).withColumnsRenamed({"doc_id": "kept_id", "tag": "kept_text"})
    return _chosen(docs, kept, F.coalesce(docs["doc_id"], F.lit(repeats.NO_ID)), F.xxhash64)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that occur elsewhere, too; a character cut in two goes as a whole."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = repeats.cut_repeats(docs, carry=rest, whole_characters=True)
    found = cut.withColumn("text", F.col("kept").cast("string"))
    found = found.withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*(F.col(c) if c in ("doc_id", "text", "n_chars") else F.col(f"carried.{c}") for c in docs.columns))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised texts in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", sequences),
]

#: The classifier of the first stage can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
