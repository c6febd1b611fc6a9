"""Near-duplicate detection by one-permutation MinHash with optimal densification.

One hash per shingle picks a bin (its high bits) and a value; a bin keeps its
least value.  An empty bin borrows from the bin that a hash of (bin, attempt)
names, attempt after attempt, until that one is not empty.  ``ROWS`` bins make
a band; documents with an equal band share a bucket.

Documents with equal shingle sets are one class, a node named by 64 bits of its
set's key; one row of each class, one of its smallest id, is banded.  Classes
that share an id are linked.  Candidate edges of a bucket are a star:
one centre against the others.  A link is confirmed on the full shingle sets.

Shingles that no other banded candidate has (``lone``) bound what a document
can share: of a pair, at most the smaller number of shingles that are not lone.
Pairs whose sizes rule a link out by that bound are not confirmed.  A bucket's
centre is its member with the fewest lone shingles, the likely origin of a
group of edited copies.  Members that a star leaves in different components go
on to further rounds, in which the next 8, 64, ... members of a bucket are
centres, until every bucket holds one component or every member of it has been
a centre: no pair of a bucket is left out unless its documents are connected
or their sizes rule a link out.  After the first round a pair is taken up only
in the first of the buckets that it shares (told by the band keys of both),
and only if the two share one of their rarest shingles: with o shingles needed
in common, one of them is among the first size - o + 1 of either set in any
order that is the same for all, here by the number of open sets that hold it.

Defined cases: a text without words is linked with nothing; a shorter text
than a shingle is one shingle; rows with a null id take no part (their
component is null, they are kept); rows repeating an id are one document,
linked by any of their texts; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import materialize, shuffle_partitions
from cumulus.llm.components import star_edges
from cumulus.llm.shingles import SMALL_TEXT, mix, shingle_sets, slices

BANDS, ROWS = 40, 5
CENTRES = 8  # the number of centres of a bucket grows by this factor each round


def signatures(ends: np.ndarray, hashes: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """Densified one-permutation signatures of non-empty sorted sets, one row each."""
    n = len(ends) - 1
    sets = np.repeat(np.arange(n), np.diff(ends))
    place = (((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64) + sets * bins
    first = np.flatnonzero(np.diff(place, prepend=-1))  # sets are sorted, so a bin's first hash is its least
    sig = np.zeros(n * bins, np.uint64)
    full = np.zeros(n * bins, bool)
    sig[place[first]], full[place[first]] = hashes[first], True
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        bin_of = empty % bins
        salt = np.uint64(attempt * 0x9E3779B97F4A7C15 % 2**64)
        named = mix(bin_of.astype(np.uint64) + salt) % np.uint64(bins)
        lender = empty - bin_of + named.astype(np.int64)
        lent = full[lender]
        sig[empty[lent]] = sig[lender[lent]]
        empty = empty[~lent]
    return sig.reshape(n, bins)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    parts = sig.reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def _set_keys(ends, hashes):
    """A 128-bit key of each non-empty set, the same for equal sets."""
    salts = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
    return [np.add.reduceat(mix(hashes ^ s), ends[:-1]).view(np.int64) for s in salts]


def _sign(words: int, bands: int, rows: int):
    def run(batches):
        for whole in batches:
            for b in slices(whole, "text", SMALL_TEXT):
                ends, hashes = shingle_sets(b.column("text"), words)
                size = np.diff(ends)
                some = np.flatnonzero(size)
                k1 = k2 = np.empty(0, np.int64)
                keys = np.empty((0, bands), np.int64)
                if len(some):
                    own = np.concatenate([[0], np.cumsum(size[some])])
                    k1, k2 = _set_keys(own, hashes)
                    keys = band_keys(signatures(own, hashes, bands * rows), bands, rows)
                back = np.full(len(size), -1)
                back[some] = np.arange(len(some))
                take = pa.array(back, mask=back < 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands),
                                                 pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(size.astype(np.int64)), pa.array(k1).take(take), pa.array(k2).take(take),
                     lists.take(take)], ["id", "n", "k1", "k2", "bands"])
    return run


def _sets(words: int):
    """The columns beside the text and the shingles of each text, of those whose set has the keys k1, k2 if given."""
    def run(batches):
        for whole in batches:
            rest = [c for c in whole.schema.names if c not in ("text", "k1", "k2")]
            for b in slices(whole, "text", SMALL_TEXT):
                ends, hashes = shingle_sets(b.column("text"), words)
                some = np.flatnonzero(np.diff(ends))
                if not len(some):
                    continue
                ends = np.concatenate([[0], ends[some + 1]])
                rows = b.take(pa.array(some))
                keys = dict(zip(("k1", "k2"), map(pa.array, _set_keys(ends, hashes)), strict=True))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
                made = pa.RecordBatch.from_arrays([*[rows.column(c) for c in rest], *keys.values(), lists],
                                                  [*rest, *keys, "shingles"])
                if "k1" in b.schema.names:
                    made = made.filter(pc.and_(*[pc.equal(rows.column(k), keys[k]) for k in keys])).drop_columns(["k1", "k2"])
                yield made
    return run


def _possible(n_a, n_b, lone_a, lone_b, percent: int):
    """Necessary for a link: what both can share reaches ``percent`` of the least possible union."""
    n_a, n_b = F.col(n_a), F.col(n_b)
    common = F.least(n_a - F.col(lone_a), n_b - F.col(lone_b))
    return common * 100 >= (n_a + n_b - common) * percent


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets.

    ``sets`` is bucketed by id, so the partners' and the centres' sets are found in place; the one set that a
    pair must ship goes to its centre by a plain equi-join, in which the skew join splits a centre with very many
    partners.
    """
    left = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    right = sets.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi").select(
        F.col("id").alias("a"), F.col("shingles").alias("sa"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "b").join(right, "a")
            .select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("s"))
            .where(F.col("c") * 100 >= (F.col("s") - F.col("c")) * percent).select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col="doc_id", text_col="text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over confirmed links), kept."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(
        base.mapInArrow(_sign(words, bands, rows), "id long, n long, k1 long, k2 long, bands array<long>"), "signed")
    able = signed.where("n > 0 AND id IS NOT NULL")
    # equal sets have equal bands, so any row's will do
    classes = materialize(able.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
                          .withColumn("node", F.xxhash64("k1", "k2")), "classes")
    named = classes.select("k1", "k2", F.col("rep").alias("doc"), F.col("node").alias("id"))
    members = materialize(_in_shared_buckets(
        classes.select(F.col("node").alias("id"), F.explode("bands").alias("key"))), "members")
    sigs = classes.select(F.col("node").alias("id"), F.col("bands").alias("sig"))
    classes = classes.drop("bands")
    of_id = able.select("id", F.xxhash64("k1", "k2").alias("node")).groupBy("id").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    shared = (able.select("id", F.xxhash64("k1", "k2").alias("b")).join(of_id.select("id", "a"), "id")
              .where("a <> b").select("a", "b").distinct())
    shared = materialize(shared, "shared")
    links = _linked(base, named, members, sigs, words, percent)
    links = shared if links is None else links.unionByName(shared)
    parts = star_edges(links).withColumnRenamed("id", "node")
    parts = materialize(classes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")),
                        "parts")
    least = parts.groupBy("component").agg(F.min("rep").alias("of_class"))
    parts = parts.join(least, "component").select("k1", "k2", "of_class")
    out = signed.select("id", "n", "k1", "k2").join(parts, ["k1", "k2"], "left")
    # a row without words goes with the other texts of its id
    bare = signed.where("n = 0 AND id IS NOT NULL").select("id").distinct()
    of_bare = (able.select("id", "k1", "k2").join(bare, "id", "left_semi").join(parts, ["k1", "k2"])
               .groupBy("id").agg(F.min("of_class").alias("of_id")))
    out = out.join(of_bare, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("of_class", "of_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _linked(base: DataFrame, named: DataFrame, members: DataFrame, sigs: DataFrame, words: int,
            percent: int) -> DataFrame | None:
    """Edges (a, b) that connect what the confirmed links of nodes connect; None if there is none.

    ``named``: (k1, k2, doc, id), the row of a node; ``members``: (id, key), its buckets; ``sigs``: (id, sig), all its
    band keys in order.
    """
    if members.isEmpty():
        return None
    spark = base.sparkSession
    table = f"shingle_sets_{uuid.uuid4().hex}"
    buckets = shuffle_partitions(spark)
    # one shuffle of sets: later joins by id read them in place, each set once
    (_sets_of(base, named.join(members.select("id").distinct(), "id", "left_semi"), words)
     .groupBy("id").agg(F.first("shingles").alias("shingles"))
     .write.format("parquet").bucketBy(buckets, "id").sortBy("id").saveAsTable(table))
    try:
        return _rounds(members, spark.table(table), sigs, percent)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _sets_of(base: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the nodes ``asked``; a row that repeats a text gives its node again.

    The texts are joined by document id, by shuffle at every size: the ids grow with the documents.
    """
    asked = materialize(asked, "asked")
    texts = asked.groupBy("doc").agg(F.count(F.lit(1)).alias("c"))
    # a document with one set asked for: its keys go along with the text, nothing is shuffled after that
    one = asked.join(texts.where("c = 1"), "doc").select("doc", "k1", "k2", F.col("id").alias("node"))
    sets = base.join(one.hint("merge"), base["id"] == one["doc"]).select("node", "k1", "k2", "text").mapInArrow(
        _sets(words), "node long, shingles array<long>").select(F.col("node").alias("id"), "shingles")
    many = materialize(asked.join(texts.where("c > 1"), "doc", "left_semi"), "asked")
    if not many.isEmpty():  # ids on several texts: joined by document and set
        found = base.join(many.select(F.col("doc").alias("id")), "id", "left_semi").select(
            F.col("id").alias("doc"), "text").mapInArrow(_sets(words), "doc long, k1 long, k2 long, shingles array<long>")
        sets = sets.unionByName(found.join(many, ["doc", "k1", "k2"]).select("id", "shingles"))
    return sets


def _rounds(members: DataFrame, sets: DataFrame, sigs: DataFrame, percent: int) -> DataFrame | None:
    sized = sets.select("id", F.size("shingles").cast("long").alias("n")).join(_lone(sets), "id", "left")
    members = materialize(_in_shared_buckets(
        members.join(sized, "id").withColumn("lone", F.coalesce("lone", F.lit(0)))
        .where((F.col("n") - F.col("lone")) * 100 >= F.col("n") * percent)), "members")
    tested, centres, parts = None, 1, None
    while not members.isEmpty():
        order = [F.col("lone"), F.col("id")]
        rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
        chosen = members.withColumn("r", rank).where(F.col("r") <= centres)
        heads = chosen.select("key", *[F.col(c).alias(f"{c}_a") for c in chosen.columns if c not in ("key", "r")])
        pairs = members.join(heads, "key").where(
            (F.struct("lone_a", "id_a") < F.struct(*order)) & _possible("n_a", "n", "lone_a", "lone", percent))
        if "part" in members.columns:
            pairs = pairs.where("part_a <> part")
        if "sig" in members.columns:
            same = F.zip_with("sig_a", "sig", lambda x, y: x == y)
            pairs = pairs.where(F.get("sig", (F.array_position(same, True) - 1).cast("int")) == F.col("key"))
            needed = F.ceil((F.col("n_a") + F.col("n")) * percent / (100 + percent))
            first = lambda rare, n: F.slice(rare, 1, F.greatest(F.col(n) - needed + 1, F.lit(0)).cast("int"))
            pairs = pairs.where(F.arrays_overlap(first("rare_a", "n_a"), first("rare", "n")))
        pairs = pairs.select(F.col("id_a").alias("a"), F.col("id").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = materialize(confirm(pairs, sets, percent), "links")
        if not found.isEmpty():
            # the components so far stand for the links that made them
            known = found if parts is None else found.unionByName(parts.select(F.col("id").alias("a"), F.col("part").alias("b")))
            parts = star_edges(known).withColumnRenamed("component", "part")
        # what goes on: members that have not been centres, in buckets of two or more components
        left = members.drop("part").join(chosen.select("key", "id"), ["key", "id"], "left_anti")
        if parts is None:
            left = left.withColumn("part", F.col("id"))
        else:
            left = left.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
        open_ = left.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("key")
        left = left.join(open_, "key")
        if "sig" not in left.columns:
            left = materialize(left, "left")
            left = left.join(sigs, "id").join(
                _rarest(sets.join(left.select("id").distinct(), "id", "left_semi"), percent), "id")
        members = materialize(left, "members")
        centres *= CENTRES
    return None if parts is None else parts.select(F.col("id").alias("a"), F.col("part").alias("b"))


def _lone(sets: DataFrame) -> DataFrame:
    """(id, lone): how many shingles of each set no other set has, if any; counted on the map side first."""
    one = sets.select("id", F.explode("shingles").alias("s"))
    once = one.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).where("c = 1")
    return once.groupBy("id").agg(F.count(F.lit(1)).alias("lone"))


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(id, rare): of each set the shingles that fewest sets hold, as many as any link could need."""
    one = sets.select("id", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    held = one.groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    ranked = one.join(held, "s").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("ranked"))
    most = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    return ranked.select("id", F.transform(F.slice("ranked", F.lit(1), most), lambda x: x["s"]).alias("rare"))


def _in_shared_buckets(members: DataFrame) -> DataFrame:
    """The rows whose ``key`` another row has too."""
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return members.join(shared, "key")
