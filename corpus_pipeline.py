"""A cleaning pipeline over ``documents``: language, repeated lines, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of documents; columns beside these, also ones with names
that a stage uses itself, are dropped by the first.

Defined cases, stage by stage:

* language_id: a null, empty or letterless text goes; a null id or label stays;
  rows that repeat a document are judged alike, each.
* line_dedup: rows with one id are one document, a line that it owns stays in
  each of them; a row with a null id keeps its lines; a null text counts as one
  empty line and becomes an empty text; a text may become empty.
* near_dedup: rows with a null id, and texts without words, stay; rows with one
  id stay or go together, so rows that repeat a kept document stay, each.
* personal_data: null ids and repeated rows are masked like any other.
* packing: an empty text has one row without a bin; repeated rows are packed each.

An empty table stays one through all stages.  ``n_chars`` is counted anew
whenever a text may have changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulus.llm import langid, line_dedup, minhash, packing, pii
from cumulus.llm.common import materialize, read_table
from cumulus.llm.queries import VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CONFIDENT = 0.9  # a prediction of this score or more replaces the label
ORACLE_SQL = None  # SQL expresses neither the trained language model nor best-fit packing; tested by brute force


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (null, empty or letterless text) go.  ``lang`` becomes the
    prediction where that is confident or no label was given.  A low score alone rejects nothing: clean documents
    of a word or two have the lowest.  The model learns from the labelled documents."""
    model = langid.fit(docs, F.lit(True))
    known = langid.predict(docs.select(*COLUMNS), model, keep_text=True).where(F.col("lang_pred") != langid.UNKNOWN)
    told = F.when(F.col("score") >= CONFIDENT, F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))
    return _documents(known.withColumn("lang", told))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more characters stay in the first document that holds them; every document stays."""
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 or more similar five-word shingles the smallest id stays."""
    gone = minhash.near_duplicates(docs, words=5, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in angle brackets; every document stays."""
    found = pii.find_personal_data(docs.select(*COLUMNS))
    return _documents(found.withColumn("text", F.col("redacted")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences of the permitted lengths, in tokens."""
    import public_tokenizers as P

    return packing.pack_tokens(docs, P.path(VOCABULARY), P.PATTERN)


STAGES = [
    ("language_id", keep_known_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
