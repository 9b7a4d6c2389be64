"""Exact similarity join of documents on word shingles, by a partition of the universe of shingles.

Sets r and s with Jaccard similarity of at least p percent differ in at most D(r, s) =
(|r| + |s|) (100 - p) / (100 + p) elements. Hash ranges cut the universe into segments, as many as the
size band of the smaller set needs; each difference spoils one segment, so of any D + 1 segments of r one
at least has the same subset in s. Where D is at most 1 the whole set and all sets with one element less
do instead. Among its segments every set then picks the D + 1 whose subsets are rarest: if none of those
has company, the set has no partner at all. As all sets go by one order, the first subset in it that two
partners share is among the picks of both, so a line that many texts have joins only those that are little
else. What remains is verified on full sets.

Equal sets are one class from the start, and classes of candidates are compared block by block, so that a
large group of copies is never spelled out in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdloom.llm.base import (
    SLICE_ROWS,
    arrow_schema,
    discard,
    free_name,
    key_filter,
    map_batches,
    map_slices,
    passes,
    prepare,
    release,
    release_shuffles,
    stored,
    texts,
)

#: Words of a shingle and the least similarity in percent.
SHINGLE, PERCENT = 5, 75
#: Least number of groups of signatures, and signatures that a group takes at most on average: 13 bytes each.
BUCKETS, BUCKET_SIGNATURES = 256, 4 << 20
#: Signatures that a task holds before it sends them on.
FLUSH = 150_000
#: Classes of a signature that a task sends to its bucket at a time.
KNOWN = 2
#: Classes of a block and elements of their sets, on average; candidates are compared within pairs of blocks.
BLOCK, BLOCK_ELEMENTS = 512, 1 << 19
#: Bytes of sets that a task compares, on average, but for single pairs of blocks.
TASK_BYTES = 16 << 20
#: Standard deviations that keep the number of subsets of a set above what it needs.
MARGIN = 9
#: Stands for a NULL id in the filter.
NO_ID = -(1 << 63) + 1

MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PLACES = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    total = hashes[:n] * PLACES[0]
    for i in range(1, SHINGLE):
        total = total + mix(hashes[i : i + n] ^ PLACES[i]) * PLACES[i]
    return np.unique(mix(total))


def class_id(items: np.ndarray) -> int:
    """Key of a set; a 64-bit hash of its sorted elements and their number."""
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


def most_different(a: int, b: int, percent: int = PERCENT) -> int:
    return (a + b) * (100 - percent) // (100 + percent)


def largest_partner(n: int, percent: int = PERCENT) -> int:
    return n * 100 // percent


class Bands:
    """Size bands and the number of segments of each.

    Cost decides how a band is signed. A set of n elements costs n + 1 signatures with one-element
    deletions, possible while no pair differs by more than 1; n with each element a segment of its own;
    or as many as it has non-empty segments. Segments are as few as leave every set, but for a chance of
    some 1 in 10^18, with enough of them non-empty; where that takes more than n, elements are cheaper.
    """

    STEP = 1.75

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        small = 1
        while most_different(small + 1, largest_partner(small + 1, percent), percent) <= 1:
            small += 1
        #: First size and number of segments of each band: 0 deletions, -1 elements.
        self.first, self.segments = [1], [0]
        start = small + 1
        fine = start
        while self._needed(int(fine * self.STEP)) is None:
            fine += max(1, fine // 8)
        if fine > start:
            self.first.append(start)
            self.segments.append(-1)
        size = fine
        while size < 1 << 40:
            following = int(size * self.STEP)
            self.first.append(size)
            self.segments.append(self._needed(following))
            size = following

    def _needed(self, size: int) -> int | None:
        """Segments for sets below ``size``, or None where elements cost less."""
        n = size - 1
        need = most_different(n, largest_partner(n, self.percent), self.percent) + 1
        m = need
        while m < n:
            empty = exp(-n / m)
            spread = sqrt(max(m * empty * (1 - (1 + n / m) * empty), 0.0))
            if m * (1 - empty) - MARGIN * spread - 1 >= need:
                return m
            m += max(1, m // 100)
        return None

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.first, n, "right")) - 1

    def roles(self, n: int) -> list[tuple[int, int]]:
        """(band, D + 1) under which a set of ``n`` elements looks for partners.

        Pairs meet in the band of their smaller set: the own band, and lower bands that reach up to the
        smallest partner.
        """
        own = self.of(n)
        out = [(own, most_different(n, largest_partner(n, self.percent), self.percent) + 1)]
        least = -(-n * self.percent // 100)
        band = own - 1
        while band >= 0 and self.first[band + 1] - 1 >= least:
            out.append((band, most_different(n, self.first[band + 1] - 1, self.percent) + 1))
            band -= 1
        return out

    def sign(self, items: np.ndarray, band: int) -> np.ndarray:
        """Signatures of a set in a band: its non-empty subsets, elements, or deletions."""
        salt = np.array([band + 1], np.uint64) * MIX[0]
        m = self.segments[band]
        element = mix(items ^ MIX[0])
        if m == 0:
            total = element.sum(dtype=np.uint64, keepdims=True)
            return mix(np.append(total - element, total) ^ salt)
        if m == -1:
            return mix(element ^ salt)
        segment = ((items >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        return mix(np.add.reduceat(element, starts) ^ mix(segment[starts] + salt))


    def count(self, items: np.ndarray, band: int) -> int:
        """Number of signatures of a set in a band."""
        m = self.segments[band]
        if m < 1:
            return len(items) + (m == 0)
        segment = ((items >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        return 1 + int(np.count_nonzero(segment[1:] != segment[:-1]))

    def missing(self, items: np.ndarray) -> list[tuple[int, int]]:
        """(band, D + 1 less its signatures) for each role; above 0 where a set has too few of them."""
        roles = [(band, need, self.count(items, band)) for band, need in self.roles(len(items))]
        return [(band, 0 if self.segments[band] == 0 else need - count) for band, need, count in roles]


def sets_of(df: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame:
    """(id, n, class, bands, missing) of every row; an empty set has no class and no bands."""
    ddl = f"{id_column} bigint, n bigint, class bigint, bands array<bigint>, missing array<bigint>"

    def make():
        bands = Bands(percent)

        def work(batch):
            found = [shingle_set(t) for t in texts(batch, text_column)]
            roles = [bands.missing(s) if len(s) else [] for s in found]
            return [
                batch.column(id_column),
                [len(s) for s in found],
                [class_id(s) if len(s) else None for s in found],
                [[band for band, _ in r] for r in roles],
                [[need for _, need in r] for r in roles],
            ]

        return work

    return map_slices(df.select(id_column, text_column), make, ddl)


def signatures(df: DataFrame, text_column: str, percent: int, buckets: int) -> DataFrame:
    """(bucket, signs, classes, bands): packed signatures of the distinct sets of each task.

    A set that a task has met before is not signed again, so a group of copies costs a set per task; one so
    small that only equal sets are similar is not signed at all. Of a signature, only the first two classes that a task holds at a time go to its bucket. They tell it all it
    needs; the others are known to be in company and go, spread by class, to groups below 0. So the share
    of a group of near copies in a bucket grows with the tasks, not with the group.
    """
    prepare(df.sparkSession)
    ddl = "bucket int, signs binary, classes binary, bands binary"
    schema = arrow_schema(ddl)

    def packed(keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        """One row per key, its values of each column as bytes."""
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        ends = np.append(starts[1:], len(keys))
        arrays = [pa.array(keys[starts])]
        for values in columns:
            values = values[order]
            arrays.append(pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, met, parts, size = Bands(percent), set(), [], 0

        def flush():
            counts = [len(s) for s, _, _ in parts]
            signs = np.concatenate([s for s, _, _ in parts])
            classes = np.repeat(np.array([c for _, c, _ in parts], np.int64), counts)
            bands = np.repeat(np.array([b for _, _, b in parts], np.uint8), counts)
            order = np.argsort(signs, kind="stable")
            signs, classes, bands = signs[order], classes[order], bands[order]
            starts = np.flatnonzero(np.append(True, signs[1:] != signs[:-1]))
            place = np.arange(len(signs)) - np.repeat(starts, np.diff(np.append(starts, len(signs))))
            bucket = (signs % np.uint64(buckets)).astype(np.int32)
            short = (signs >> np.uint64(32)).astype(np.uint32)
            first = place < KNOWN
            yield packed(bucket[first], short[first], classes[first], bands[first])
            if not first.all():
                rest = ~first
                names = sign_name(short[rest], bucket[rest])
                yield packed(-1 - (classes[rest] % buckets).astype(np.int32), names, classes[rest], bands[rest])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for text in texts(batch.slice(at, SLICE_ROWS), text_column):
                    items = shingle_set(text)
                    key = class_id(items)
                    if key in met or not most_different(len(items), largest_partner(len(items), percent), percent):
                        continue
                    met.add(key)
                    for band, _ in grades.roles(len(items)):
                        parts.append((grades.sign(items, band), key, band))
                        size += len(parts[-1][0])
                if size >= FLUSH:
                    yield from flush()
                    parts, size = [], 0
        if parts:
            yield from flush()
        del met, parts
        release()

    return df.select(text_column).mapInArrow(run, ddl)


def sign_name(short: np.ndarray, bucket) -> np.ndarray:
    """A signature as one number: its 32 bits within a bucket and the bucket."""
    return short.astype(np.int64) << 24 | bucket


def shared_signatures(packed: DataFrame) -> DataFrame:
    """(class, band, sign): signatures that at least two classes have, one row per class, more for copies.

    ``sign`` keeps 32 bits within a bucket: a chance match adds a candidate and loses none.
    """
    ddl = "class bigint, band int, sign bigint"
    schema = arrow_schema(ddl)

    def collide(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        signs, classes, bands = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
            for c, kind in (("signs", np.int64 if bucket < 0 else np.uint32), ("classes", np.int64), ("bands", np.uint8))
        )
        if bucket < 0:
            arrays = [classes, bands.astype(np.int32), signs]
            return pa.Table.from_arrays([pa.array(a) for a in arrays], schema=schema)
        order = np.lexsort((classes, signs))
        signs, classes, bands = signs[order], classes[order], bands[order]
        fresh = np.append(True, (signs[1:] != signs[:-1]) | (classes[1:] != classes[:-1]))
        signs, classes, bands = signs[fresh], classes[fresh], bands[fresh]
        starts = np.flatnonzero(np.append(True, signs[1:] != signs[:-1]))
        count = np.diff(np.append(starts, len(signs)))
        keep = np.repeat(count, count) > 1
        sign = sign_name(signs[keep], bucket)
        arrays = [classes[keep], bands[keep].astype(np.int32), sign]
        return pa.Table.from_arrays([pa.array(a) for a in arrays], schema=schema)

    return packed.groupBy("bucket").applyInArrow(collide, ddl)


def candidate_edges(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(class, pivot): stars that join all classes which may be partners.

    Of the signatures of a class in a band, those of no other class are free; it needs D + 1, and takes of the
    others the rarest. A class with D + 1 free ones is out. The order is the same for all classes, so the first
    signature that two partners share is taken by both: at most D of either's own come before it. Classes that
    took one signature are joined to the least of them.
    """
    roles = classes.select("class", F.explode(F.arrays_zip("bands", "missing")).alias("role"))
    roles = roles.select("class", F.col("role.bands").cast("int").alias("band"), F.col("role.missing").alias("missing"))
    own = W.partitionBy("class", "band")
    # Tasks that met copies of one set may each have sent its signatures, so ``rows`` may exceed the classes
    # of a signature: all the order needs is that it is one number for all of them. The rows of a class are
    # put together once, for this grouping, the window and the join alike.
    often = shared.groupBy("sign").agg(F.count("*").alias("rows"))
    once = shared.join(often, "sign").repartition("class", "band").groupBy("class", "band", "sign").agg(F.max("rows").alias("rows"))
    ranked = once.withColumns(
        {"total": F.count("*").over(own), "place": F.row_number().over(own.orderBy("rows", "sign"))}
    ).join(roles, ["class", "band"])
    taken = stored(ranked.filter(F.col("place") <= F.col("missing") + F.col("total")).select("class", "sign"), "join-taken")
    groups = taken.groupBy("sign").agg(F.min("class").alias("pivot"), F.max("class").alias("last"))
    groups = groups.filter(F.col("pivot") < F.col("last")).select("sign", "pivot")
    return taken.join(groups, "sign").filter(F.col("class") != F.col("pivot")).select("class", "pivot").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of the connected component of every node of ``edges`` (a, b).

    Large and small stars in turn until nothing changes, some log n rounds; each is written to the shared
    folder. Least neighbours are found with sums per task first and joined back, so that a hub splits.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs, mark = stored(pairs, "join-pairs"), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "join-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "join-pairs")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _id_hash(id_column: str):
    return F.xxhash64(F.coalesce(F.col(id_column), F.lit(NO_ID)))


def _rows_by_filter(df: DataFrame, ids: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose id is certainly not among ``ids`` (rep), and those whose id may be."""
    bits = df.sparkSession.sparkContext.broadcast(key_filter(ids, "rep"))
    place, columns = free_name(df, "place"), df.columns
    placed = df.withColumn(place, _id_hash(id_column))

    def rows(wanted: bool) -> DataFrame:
        def work(batch):
            hit = passes(bits.value, batch.column(place).to_numpy()) == wanted
            return batch.filter(pa.array(hit)).select(columns)

        return map_batches(placed, lambda: work, df.schema)

    return rows(False), rows(True)


def candidate_sets(df: DataFrame, wanted: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(class, cluster, items) of the wanted (class, rep, cluster); only their texts are cut up again."""
    bits = df.sparkSession.sparkContext.broadcast(key_filter(wanted, "rep"))

    def make():
        passing = bits.value

        def work(batch):
            hit = passes(passing, batch.column("place").to_numpy())
            found = [shingle_set(t) for t in texts(batch.filter(pa.array(hit)), text_column)]
            found = [s for s in found if len(s)]
            return [[class_id(s) for s in found], [s.tobytes() for s in found]]

        return work

    sets = map_slices(df.select(_id_hash(id_column).alias("place"), text_column), make, "class bigint, items binary")
    return sets.join(wanted.select("class", "cluster"), "class").dropDuplicates(["class"])


def _join_small(keys: list[int], sets: list[np.ndarray], percent: int, roots: dict[int, int]) -> None:
    def root(x):
        while roots[x] != x:
            roots[x] = roots[roots[x]]
            x = roots[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            a, b = len(sets[i]), len(sets[j])
            if 100 * min(a, b) < percent * max(a, b) or root(keys[i]) == root(keys[j]):
                continue
            both = a + b - len(np.unique(np.concatenate([sets[i], sets[j]])))
            if 100 * both >= percent * (a + b - both):
                x, y = sorted((root(keys[i]), root(keys[j])))
                roots[y] = x


def _join_block(keys: list[int], sets: list[np.ndarray], percent: int, roots: dict[int, int]) -> None:
    """Links of up to two blocks from a product of their incidence matrices, a few elements at a time."""
    n, sizes = len(keys), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = often[column] > 1
    owner, column = owner[keep], column[keep]
    both, width = np.zeros((n, n), np.float32), 4096
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    column = np.cumsum(np.append(0, column[1:] != column[:-1])) if len(column) else column
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = 100 * both >= percent * union
    np.fill_diagonal(linked, True)
    label = np.arange(n)
    while True:
        least = np.where(linked, label[None, :], n).min(1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    first = {}
    for i in np.argsort(np.array(keys), kind="stable").tolist():
        first.setdefault(int(label[i]), keys[i])
    for i, key in enumerate(keys):
        roots[key] = first[int(label[i])]


def verified_edges(sets: DataFrame, percent: int) -> DataFrame:
    """(class, root): stars of classes that true links connect within each pair of blocks of a cluster.

    A cluster is cut into blocks of about ``BLOCK`` classes, fewer where sets are large, and every class
    goes to the pairs of its own block with each other one. What leaves a pair of blocks is a row per class at most.
    """
    prepare(sets.sparkSession)
    elements = F.sum(F.octet_length("items") / 8)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, elements / BLOCK_ELEMENTS)).cast("int")
    sizes = sets.groupBy("cluster").agg(blocks.alias("blocks"), (8 * elements).alias("bytes"))
    placed = sets.join(sizes.drop("bytes"), "cluster").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "items"
    )
    tasks = max(BUCKETS, int((sizes.agg(F.sum(F.col("blocks") * F.col("bytes"))).first()[0] or 0) / TASK_BYTES))
    keyed = spread.withColumn("task", F.pmod(F.xxhash64("cluster", "low", "high"), F.lit(tasks)))
    schema = arrow_schema("class bigint, root bigint")

    def verify(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(*(table.column(c).to_pylist() for c in ("cluster", "low", "high")))):
            groups.setdefault(key, []).append(i)
        classes, items, out = table.column("class").to_pylist(), table.column("items"), []
        for rows in groups.values():
            keys = [classes[i] for i in rows]
            sets = [np.frombuffer(items[i].as_py(), np.uint64) for i in rows]
            roots = {key: key for key in keys}
            (_join_small if len(keys) <= 12 else _join_block)(keys, sets, percent, roots)
            out += [(key, root) for key, root in roots.items() if key != root]
        columns = list(zip(*out)) if out else ([], [])
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return keyed.groupBy("task").applyInArrow(verify, "class bigint, root bigint")


def rest_edges(df: DataFrame, classes: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame | None:
    """(class, root): links of sets with fewer signatures than they need, compared with all sets in blocks.

    Segments are chosen so that there are none but by a chance of some 1 in 10^18.
    """
    short = classes.filter(F.exists("missing", lambda m: m > 0)).select("class", "rep", F.lit(0).cast("bigint").alias("cluster"))
    if short.isEmpty():
        return None
    short = stored(candidate_sets(df, stored(short, "join-short"), id_column, text_column), "join-short-sets")
    found, parts = None, -(-short.count() // BLOCK)
    for part in range(parts):
        block = short.filter(F.pmod(F.xxhash64("class"), F.lit(parts)) == part).select("class", "items").collect()
        sent = df.sparkSession.sparkContext.broadcast([(r["class"], bytes(r["items"])) for r in block])

        def make(sent=sent):
            queries = [(key, np.frombuffer(items, np.uint64)) for key, items in sent.value]

            def work(batch):
                out = []
                for items in map(shingle_set, texts(batch, text_column)):
                    for key, other in queries if len(items) else ():
                        both = len(np.intersect1d(items, other, assume_unique=True))
                        if 100 * both >= percent * (len(items) + len(other) - both):
                            out.append((class_id(items), key))
                return list(map(list, zip(*out))) if out else None

            return work

        edges = map_slices(df.select(text_column), make, "class bigint, root bigint")
        found = edges if found is None else found.union(edges)
    return found.filter(F.col("class") != F.col("root")).distinct()


def _labelled(df: DataFrame, id_column: str, text_column: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Sets of all rows as (id, n, class, ...), and (class, label, least_id) of all classes.

    Classes of one label are one component.
    """
    sets = stored(sets_of(df, percent, id_column, text_column), "join-sets")
    classes = sets.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(id_column).alias("least_id"),
        F.min(F.coalesce(F.col(id_column), F.lit(NO_ID))).alias("rep"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
        F.first("missing").alias("missing"),
    )
    classes = stored(classes, "join-classes")
    # A role of a set has one signature more than elements at most.
    most = classes.agg(F.sum((F.col("n") + 1) * F.size("bands"))).first()[0] or 0
    buckets = min(1 << 24, max(BUCKETS, most // BUCKET_SIGNATURES))
    shared = stored(shared_signatures(signatures(df, text_column, percent, buckets)), "join-shared")
    release_shuffles(df.sparkSession)
    candidates = candidate_edges(classes, shared)
    discard(shared)
    clusters = components(candidates)
    wanted = classes.join(clusters.withColumnsRenamed({"node": "class", "label": "cluster"}), "class")
    wanted = stored(wanted.select("class", "rep", "cluster"), "join-wanted")
    found = stored(candidate_sets(df, wanted, id_column, text_column), "join-found")
    edges = stored(verified_edges(found, percent), "join-links")
    discard(found)
    rest = rest_edges(df, classes, percent, id_column, text_column)
    named = components(edges if rest is None else edges.union(rest)).withColumnRenamed("node", "class")
    labelled = classes.join(named, "class", "left").select("class", F.coalesce("label", "class").alias("label"), "least_id")
    return sets, labelled


def link(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """``n_shingles`` and ``component_id`` of every row of ``df``, repeated rows too.

    Two rows link when the Jaccard similarity of their sets of five-word shingles is at least ``percent``;
    a component is named by its least id. A text of fewer words is one shingle. NULL, empty and wordless
    texts have no shingle and stay by themselves. NULL ids are passed over when a component is named; one
    of NULL ids only has none. Only the two named columns are read.
    """
    sets, labelled = _labelled(df, id_column, text_column, percent)
    names = labelled.groupBy("label").agg(F.min("least_id").alias("component"))
    by_class = labelled.join(names, "label").select("class", "component")
    linked = sets.join(by_class, "class", "left")
    alone = F.when(F.col("class").isNull(), F.col(id_column)).otherwise(F.col("component"))
    return linked.select(id_column, F.col("n").alias("n_shingles"), alone.alias("component_id"))


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """Rows of ``df``, with all their columns, less all but exactly one of each component.

    A row is told by its id and its set of shingles, so texts that share an id are judged apart. The row
    with the least id stays, NULL after all others, and of equal ids that with the least class; of rows that
    agree in both any one stays. Rows without shingles all stay. A filter of ids lets most rows pass as they
    are; only rows whose id may be one to go are shuffled, to be compared with the decisions themselves.
    """
    sets, labelled = _labelled(df, id_column, text_column, percent)
    rows = sets.filter(F.col("class").isNotNull()).join(labelled.select("class", "label"), "class")
    rows = rows.groupBy("label", F.col(id_column).alias("id"), "class").agg(F.count("*").alias("n"))
    rows = stored(rows, "join-rows")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "class")
    first = rows.groupBy("label").agg(F.min(order).alias("first"), F.sum("n").alias("rows"))
    first = first.filter("rows > 1").drop("rows")
    judged = rows.join(first, "label").select("id", "class", "n", order.eqNullSafe(F.col("first")).alias("stays"))
    judged = stored(judged, "join-judged")
    discard(rows)
    doubted = judged.filter(~F.col("stays") | (F.col("n") > 1))
    doubted = doubted.select(F.coalesce("id", F.lit(NO_ID)).alias("rep")).distinct()
    clear, doubtful = _rows_by_filter(df, stored(doubted, "join-doubted"), id_column)
    key, columns = free_name(df, "class_key"), df.columns

    def keyed(batch):
        found = [shingle_set(t) for t in texts(batch, text_column)]
        return batch.append_column(key, pa.array([class_id(s) if len(s) else None for s in found], pa.int64()))

    doubtful = map_batches(doubtful, lambda: keyed, f"{df.schema.simpleString()[7:-1]}, {key}: bigint")
    decisions = judged.select(
        F.col("id").alias("id_judged"), F.col("class").alias("class_judged"), F.col("n").alias("n_judged"), F.col("stays").alias("stays_judged")
    )
    same = doubtful[id_column].eqNullSafe(decisions["id_judged"]) & (doubtful[key] == decisions["class_judged"])
    again = decisions.filter("stays_judged and n_judged > 1")
    gone = decisions.filter("not stays_judged or n_judged > 1")
    kept = clear.union(doubtful.join(gone, same, "left_anti").select(columns))
    if again.isEmpty():
        return kept
    once = doubtful.join(again, same, "left_semi").dropDuplicates([id_column, key])
    return kept.union(once.select(columns))
