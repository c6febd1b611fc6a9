"""Variable-capacity best-fit packing of documents into training sequences.

Documents longer than the largest permitted length are cut into full pieces
and a rest.  Rows are dealt by position into shards of about ``SHARD_ROWS``;
each shard packs its pieces in one task, longest first: a piece goes into the
open bin that it leaves the least room in; if none has room, a bin is opened in
the permitted size of least cost per token it can still be filled with (a
fixed cost a sequence plus a cost that grows with the square of its length,
as attention does).  At the end each bin is cut down to the smallest permitted
length that holds its contents.

Shards are counted by pieces, so a shard's memory is bounded by about SHARD_ROWS
rows of three numbers, whatever the number and length of the documents; what a shard's last bins waste is a fixed number of sequences a shard.

Lengths are tokens of a byte-level vocabulary in ``pack_tokens``, any given
column or the number of words in ``pack_documents``.

Defined cases: a null text is empty; a text of length 0 gets one row with
length 0, no bin and no capacity; repeated rows are packed each; rows with a
null id too; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.byte_bpe import count_tokens
from cumulus.llm.common import materialize

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_ROWS = 1 << 15
SEQUENCE_COST = 64.0
SQUARE_COST = 1 / 32768


def cost(size: int) -> float:
    return SEQUENCE_COST + size + SQUARE_COST * size * size


def pack(lengths: list[int], capacities=CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece (none longer than the largest capacity), and each bin's capacity."""
    capacities = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rest = sum(lengths)
    bin_of, offset = [0] * len(lengths), [0] * len(lengths)
    used, size = [], []
    room: list[int] = []  # the sorted distinct rooms of open bins
    bins: dict[int, list[int]] = {}  # the open bins of a room
    for i in order:
        n = lengths[i]
        at = bisect_left(room, n)
        if at < len(room):
            free = room[at]
            b = bins[free].pop()
            if not bins[free]:
                del bins[free], room[at]
        else:
            b, free = len(used), min((c for c in capacities if c >= n), key=lambda c: (cost(c) / min(c, rest), c))
            used.append(0)
            size.append(free)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        rest -= n
        if free > n:
            if free - n not in bins:
                bins[free - n] = []
                insort(room, free - n)
            bins[free - n].append(b)
    return bin_of, offset, [capacities[bisect_left(capacities, u)] for u in used]


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("long")


def pack_tokens(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text",
                capacities=CAPACITIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``pack_documents`` by the tokens that ``byte_bpe`` makes of the whole text; counted once, as the
    row count and the packing both read the written counts."""
    counted = materialize(count_tokens(docs.select(id_col, text_col), path, pattern, text_col), "counted")
    return pack_documents(counted, id_col, F.col("n_tokens"), capacities=capacities, shard_rows=shard_rows)


def pack_documents(docs: DataFrame, id_col="doc_id", length: Column | None = None, text_col="text",
                   capacities=CAPACITIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: id, piece (from 0), start and length (in the unit of ``length``), bin_id,
    bin_offset, capacity.  ``length`` defaults to the number of words of the whole text."""
    top = max(capacities)
    sized = docs.select(F.col(id_col).cast("long").alias("id"),
                        (word_count(F.col(text_col)) if length is None else length.cast("long")).alias("n"))
    # a document is as many rows as pieces
    n = sized.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n") / top)))).first()[0] or 0
    shards = max(1, -(-n // shard_rows))
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / top) - 1).cast("int"))))
    pieces = pieces.select("id", "piece", (F.col("piece") * F.lit(top).cast("long")).alias("start"),
                           F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * F.lit(top).cast("long")).alias("length"))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending")])
        lengths = rows["length"].to_pylist()
        filled = sum(n > 0 for n in lengths)  # the empty ones are last
        bins, offset, sizes = pack(lengths[:filled], capacities)
        first = rows["shard"][0].as_py() << 32
        empty = [None] * (len(lengths) - filled)
        more = {"bin_id": [first + b for b in bins], "bin_offset": offset, "capacity": [sizes[b] for b in bins]}
        rows = rows.select(["id", "piece", "start", "length"])
        for name, values in more.items():
            rows = rows.append_column(name, pa.array(values + empty, pa.int64()))
        return rows

    got = dealt.groupBy("shard").applyInArrow(
        run, "id long, piece int, start long, length long, bin_id long, bin_offset long, capacity long")
    return got.withColumnRenamed("id", id_col)
