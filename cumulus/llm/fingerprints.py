"""Document fingerprints: bottom-k sketches of word-shingle hashes, DataFrame functions only.

A text's words are its runs outside ``[\\x20\\x09-\\x0D]``; its shingles are the
runs of five words (a shorter text: all its words as one).  The sketch is the
``k`` smallest distinct 64-bit shingle hashes in ascending order.  With fewer
than ``k`` shingles it holds them all, and every estimate below is exact.

Defined cases: a null text is empty; a text without words has an empty sketch;
two empty sketches have resemblance 1, an empty and another 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import ASCII_SPACE, MIN_LONG, let, quantile_bounds, range_of, shuffle_partitions

WORDS_PER_SHINGLE = 5
SKETCH_SIZE = 128
RANGES_PER_PARTITION = 8


def shingle_hashes(text: Column, words: int = WORDS_PER_SHINGLE) -> Column:
    """64-bit hashes of the word shingles of ``text``, repeats included."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    hashed = F.transform(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: F.xxhash64(w))
    runs = let(hashed, lambda hs: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(hs) - (words - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(hs, i, words))))
    return F.when(trimmed == "", F.array().cast("array<long>")).otherwise(runs)


def sketch(text: Column, k: int = SKETCH_SIZE, words: int = WORDS_PER_SHINGLE) -> Column:
    """Bottom-k sketch: the ``k`` smallest distinct shingle hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merge_sketches(df: DataFrame, keys: list[str], sketch_col: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per ``keys``: that of the union of the rows' shingles (a null sketch counts as empty).

    Ranks are cut to ``k`` on the map side before the shuffle, so a key with a
    third of the rows sends each task's ``k`` smallest hashes only.
    """
    cols = [F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]
    ks = [f"k{i}" for i in range(len(keys))]
    # keys in a struct, so that null keys meet in the join below
    base = df.select(F.struct(*cols).alias("key"), F.col(sketch_col).alias("s"))
    rank = F.dense_rank().over(Window.partitionBy("key").orderBy("h"))
    best = (base.select("key", F.explode("s").alias("h")).withColumn("r", rank).where(F.col("r") <= k)
            .groupBy("key").agg(F.sort_array(F.collect_set("h")).alias("merged")))
    out = base.groupBy("key").agg(F.lit(1).alias("one")).join(best, "key", "left")
    return out.select(*[F.col("key")[a].alias(c) for a, c in zip(ks, keys, strict=True)],
                      F.coalesce("merged", F.array().cast("array<long>")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard similarity of two sketches' shingle sets (exact if both hold fewer than ``k``)."""
    whole = (F.size(a) < k) & (F.size(b) < k)
    union = F.sort_array(F.array_union(a, b))
    pool = F.when(whole, union).otherwise(F.slice(union, 1, k))
    return let(pool, lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)))


def distinct_shingles(s: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles (exact below ``k``)."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds too; 1 for an empty ``a``."""
    return let(resemblance(a, b, k), lambda j: F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(
        F.lit(1.0), j * (distinct_shingles(a, k) + distinct_shingles(b, k)) / (1 + j) / distinct_shingles(a, k))))


def to_text(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next_text(docs: DataFrame, id_col="doc_id", text_col="text", next_name="next_text") -> DataFrame:
    """Columns id, text and ``next_name``, the text of the next document in descending id order
    (after the last one: the first).  A null id sorts last, equal ids by text, null texts are empty.

    One shuffle of the texts: ids are cut into ranges at ids that occur, each
    range is one window partition, and the document at a cut is also sent to
    the range that it precedes.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("ord", F.coalesce("id", F.lit(MIN_LONG)))
    bounds = quantile_bounds(base, F.col("ord"), RANGES_PER_PARTITION * shuffle_partitions(docs.sparkSession))
    bounds = largest_ids(base, bounds) or [0]
    own = range_of(F.col("ord"), bounds)
    cuts = F.array(*[F.lit(b).cast("long") for b in bounds])
    place = lambda r, copy: F.struct(r.cast("int").alias("r"), F.lit(copy).alias("copy"))
    placed = (base.withColumn("own", own)
              .withColumn("at", F.explode(F.when(
                  F.get(cuts, F.col("own")) == F.col("ord"),
                  F.array(place(F.col("own"), False), place((F.col("own") + 1) % len(bounds), True))
              ).otherwise(F.array(place(F.col("own"), False)))))
              .select(F.col("at.r").alias("r"), F.col("at.copy").alias("copy"), "ord", "id", "text"))
    w = descending()
    return placed.withColumn(next_name, F.lead("text").over(w))


def largest_ids(base: DataFrame, bounds: list[int]) -> list[int]:
    """The largest id of each range that has one: quantiles pass through double, so beyond 2^53 a bound
    need not be an id that occurs."""
    if not bounds:
        return []
    tops = base.groupBy(range_of(F.col("ord"), bounds).alias("r")).agg(F.max("ord").alias("top"))
    return sorted(r["top"] for r in tops.collect())


def descending() -> Window:
    """Window of ``with_next_text``: within a range by descending id, copied rows last."""
    return Window.partitionBy("r").orderBy("copy", F.desc("ord"), "text")


def fingerprint_edits(docs: DataFrame, id_col="doc_id", text_col="text", k: int = SKETCH_SIZE) -> DataFrame:
    """Sketch every text and its edited text (the last third of its code points replaced by as many
    from the start of the next document): id, text, edited, sketch, edited_sketch, next_sketch."""
    rows = with_next_text(docs, id_col, text_col)
    chars = F.char_length("text")
    take = F.floor(chars / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), chars - take),
                      F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), take))
    rows = rows.select("r", "copy", "ord", "id", "text", edited.alias("edited"))
    rows = rows.withColumn("sketch", sketch(F.col("text"), k)).withColumn("edited_sketch", sketch(F.col("edited"), k))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(descending()))
    return rows.where(~F.col("copy")).select(
        F.col("id").alias(id_col), "text", "edited", "sketch", "edited_sketch", "next_sketch")
