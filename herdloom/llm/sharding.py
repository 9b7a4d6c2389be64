"""Shards of near equal size that keep equal texts together, in DataFrame expressions only.

Atoms, which are never cut, stand in a fixed order: first groups of equal texts that would fill a good
part of a shard, by falling size, then buckets of all other groups by the first digits of their digest.
Their number is bounded whatever the number of texts, a bucket being some 1/65,536 of the data. The least
capacity for which greedy packing of the ordered atoms needs no more shards than wanted is found by
bisection; the cuts stay within that capacity and as near to equal shares as it permits.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdloom.llm.base import stored

#: Bytes that a row counts besides its text.
ROW_BYTES = 8
#: A group with more than this part of a shard is an atom of its own; there are at most shards / part.
HEAVY_PART = 1 / 16
#: Hexadecimal digits of the digest that name a bucket.
BUCKET_DIGITS = 4
#: Rows that one task numbers, on average.
CHUNK_ROWS = 50_000


def greedy_shards(ends: list[int], capacity: int) -> int:
    """Shards that greedy packing in order opens; ``ends`` are the running sums after a leading 0."""
    at = count = 0
    while at < len(ends) - 1:
        at = bisect_right(ends, ends[at] + capacity) - 1
        count += 1
    return count


def least_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity with which greedy packing of the sizes in order needs at most ``shards``."""
    if not sizes:
        return 0
    ends = [0, *accumulate(sizes)]
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_shards(ends, middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def cuts(sizes: list[int], shards: int) -> list[int]:
    """How many atoms lie before each of the ``shards`` - 1 cuts, no shard being above the least capacity.

    A cut may lie between the first place from which the rest still fits and the last that its shard can
    reach; the place nearest to an equal share of what remains is taken. A shard takes an atom at least and
    leaves one for each shard after it, so an atom above the equal share fills its shard and the others
    share the rest evenly; only with fewer atoms than shards some stay empty.
    """
    ends, capacity = [0, *accumulate(sizes)], least_capacity(sizes, shards)
    first = [len(sizes)]
    for _ in range(shards - 1):
        first.append(bisect_left(ends, ends[first[-1]] - capacity))
    first.reverse()
    out, at = [], 0
    for k in range(shards - 1):
        last = bisect_right(ends, ends[at] + capacity) - 1
        wanted = ends[at] + (ends[-1] - ends[at]) / (shards - k)
        best = bisect_left(ends, wanted)
        if best > 0 and (best == len(ends) or wanted - ends[best - 1] <= ends[best] - wanted):
            best -= 1
        # Every atom fits a shard, so these two bounds keep within first[k] and last.
        best = min(max(best, at + 1), max(len(sizes) - (shards - k - 1), at + 1), len(sizes))
        at = max(first[k], min(best, last))
        out.append(at)
    return out


def heavy_groups(rows: DataFrame, shards: int) -> DataFrame:
    """(digest, atom, size) of groups that are atoms of their own.

    Sizes are summed within tasks first, so that a text which a third of all rows share is a row per task.
    """
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    limit = rows.agg((F.sum("size") * (HEAVY_PART / shards)).alias("limit"))
    by_size = F.lpad((F.lit(10**18) - F.col("size")).cast("string"), 18, "0")
    heavy = groups.filter(F.col("size") > limit.scalar())
    return heavy.select("digest", F.concat(F.lit("0"), by_size, "digest").alias("atom"), "size")


def atom_sizes(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """(atom, size) of all atoms: sums per bucket, less what the heavy groups take out of it."""
    sums = rows.groupBy(bucket().alias("atom")).agg(F.sum("size").alias("size"))
    out = heavy.select(bucket().alias("atom"), (-F.col("size")).alias("size"))
    rest = sums.union(out).groupBy("atom").agg(F.sum("size").alias("size")).filter("size > 0")
    return rest.union(heavy.select("atom", "size"))


def bucket():
    return F.concat(F.lit("1"), F.substring("digest", 1, BUCKET_DIGITS))


def assign_shards(df: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shard 0 to ``shards`` - 1 of every row of ``df``, with sizes near equal, and a place within it.

    The size of a row is the UTF-8 bytes of its text, none for NULL, plus ``ROW_BYTES``. Rows with equal
    texts, also those without text, share a shard, so one above the mean is as large as its largest group
    at most. Places ``slot`` count from 0 without gaps, by digest chunk and id. Repeated rows and NULL ids
    each get a place of their own. With fewer atoms than shards some stay empty; no row, no shard.

    Only sums per atom reach the driver. The text is read once; digests and sizes are stored and all
    else works on them. Rows are numbered in chunks, each after those before it.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = stored(
        df.select(
            F.col(id_column).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("digest"),
        ),
        "shard-rows",
    )
    heavy = stored(heavy_groups(rows, shards), "shard-heavy")
    found = sorted((r["atom"], r["size"]) for r in atom_sizes(rows, heavy).collect())
    at = cuts([size for _, size in found], shards)
    keys = [found[a][0] if a < len(found) else "2" for a in at]
    atom = F.coalesce(F.col("atom"), bucket())
    shard = sum(((atom >= key).cast("int") for key in keys), F.lit(0))
    placed = rows.join(heavy.select("digest", "atom"), "digest", "left").withColumn("shard", shard)
    return numbered(placed, rows.count()).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def numbered(placed: DataFrame, rows: int) -> DataFrame:
    """``placed`` with a gapless ``slot`` per shard: numbers within chunks on top of the chunks before."""
    chunks = max(1, rows // CHUNK_ROWS)
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("id", "digest"), F.lit(chunks)))
    counts = chunked.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("shard", "chunk").orderBy("id", "digest")
    ranked = chunked.withColumn("rank", F.row_number().over(within) - 1)
    return ranked.join(starts, ["shard", "chunk"]).withColumn("slot", (F.col("start") + F.col("rank")).cast("bigint"))
