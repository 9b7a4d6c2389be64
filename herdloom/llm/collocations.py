"""Phrase collocations of each language, from Misra-Gries summaries and an exact second pass.

Phrases of up to three words are dealt to partitions by hash. A task counts the phrases of a stretch of
text and sends every partition a summary of its own; a partition merges these into one that holds at
most mass / threshold + 1 counters, mass being the number of occurrences it was sent. Merging may take
from every counter what the first one beyond that number has; all in all it takes less than the
threshold, so each phrase that occurs as often as the threshold keeps a counter above zero. What is left
becomes a bit filter, and a second pass over the texts counts the phrases that pass it as they are. A
phrase that passes by chance is counted as well and falls to the threshold then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdloom.llm.base import SLICE_ROWS, arrow_schema, prepare, release, stored, texts

#: Words of the longest phrase, least occurrences of a candidate, rows per language, and the percentage of
#: its occurrences inside one longer candidate from which a candidate is part of that.
LONGEST, LEAST, TOP, COVERED = 3, 10, 2000, 50
#: Occurrences that a hash partition takes, so that its summary (a tenth of that) fits into a task, and
#: the least number of partitions.
PARTITION_MASS, PARTITIONS = 1 << 24, 64
#: Bytes of text that a task counts before it passes its summaries on; counting takes some 20 times as much memory.
FLUSH_BYTES = 4 << 20
#: Summaries of tasks that a merging task turns into arrays at a time.
MERGE_ROWS = 16
#: Bits of the filter per surviving phrase, and bits that it has at most (16 MB). Beyond that it lets
#: more phrases into the second pass, whose counts are exact with any filter.
BITS, MOST_BITS = 16, 1 << 27
#: Parts of a language whose first rows are found on their own.
SALTS = 64
NO_LANGUAGE = "und"

# Characters that end a piece; all of them stand for a full stop once read.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
READ = bytes.maketrans(
    BREAKS + b"\t" + bytes(range(65, 91)), BREAK * len(BREAKS) + b" " + bytes(range(97, 123))
)

MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
CHAIN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, and a full stop wherever a piece ends."""
    return text.encode().translate(READ).replace(BREAK, b" . ").split()


class Numbers(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Grams:
    """Phrases of one size in a stretch of text: hash and count of each, and how they are made up."""

    def __init__(self, hashes, counts, before, last):
        self.hashes, self.counts, self.before, self.last = hashes, counts, before, last


def grams(words: np.ndarray, hashes: np.ndarray, longest: int, passes=None) -> Iterator[Grams]:
    """Phrases of 1 to ``longest`` words in ``words`` (0 ends a piece), ``hashes`` being those of the words.

    They come size by size, as only a caller that needs the shorter ones later has to hold them all. A phrase
    is the number of the one without its last word, and that word. With ``passes`` only phrases whose hashes
    pass, and whose beginnings do, are counted.
    """
    padded = np.append(words, np.zeros(longest, words.dtype))
    start = np.flatnonzero(words).astype(words.dtype)
    counts = np.bincount(words, minlength=len(hashes))
    group, sofar, numbers = words[start], hashes, np.arange(len(hashes), dtype=words.dtype)
    counts[0] = 0
    before, last = np.full(len(hashes), -1, words.dtype), numbers
    for size in range(1, longest + 1):
        if size > 1:
            follow = padded[start + (size - 1)]
            keep = follow > 0
            start, group, follow = start[keep], group[keep], follow[keep]
            keys = group.astype(np.int64) << 32 | follow
            del follow, keep, before, last, counts
            # As np.unique does, with 32-bit numbers and no more arrays than needed.
            order = np.argsort(keys)
            keys = keys[order]
            new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
            group[order] = np.cumsum(new, dtype=words.dtype) - 1
            del order
            counts = np.diff(np.append(np.flatnonzero(new), len(keys)))
            keys = keys[new]
            before, last = (keys >> 32).astype(words.dtype), (keys & 0xFFFFFFFF).astype(words.dtype)
            del keys, new
            sofar = mix(sofar[before] * CHAIN + hashes[last])
        if passes is not None:
            good = passes(sofar)
            counts = np.where(good, counts, 0)
            keep = good[group]
            start, group = start[keep], group[keep]
        yield Grams(sofar, counts, before, last)


class Stretch:
    """Words of texts per language, up to some megabytes of text."""

    def __init__(self):
        self.numbers, self.words, self.size = Numbers(), {}, 0

    def add(self, lang: str, text: str) -> None:
        words = words_of(text)
        words.append(BREAK)
        self.words.setdefault(lang, []).append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(text)

    def phrases(self, longest: int, passes=None) -> Iterator[tuple[str, int, Iterator[Grams]]]:
        """(language, words, phrases by size) of each language."""
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, self.numbers), np.uint64, len(self.numbers))
        for lang, parts in self.words.items():
            words = np.concatenate(parts)
            hashes = mix(own ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), 1)))
            yield lang, int(np.count_nonzero(words)), grams(words, hashes, longest, passes)


def _stretches(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[Stretch]:
    stretch = Stretch()
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            for lang, text in zip(part.column("lang").to_pylist(), texts(part)):
                stretch.add(lang, text)
                if stretch.size >= flush:
                    yield stretch
                    stretch = Stretch()
    if stretch.size:
        yield stretch
    del stretch
    release()


def summaries(df: DataFrame, partitions: int, longest: int) -> DataFrame:
    """(part, kind, mass, keys, often): what tasks found for each hash partition.

    A row of kind 0 tells the mass of the row of kind 1 that goes with it, whose keys are 32 bits of the
    hashes, those of phrases found once at the end; ``often`` has 32-bit counts of the others. A task holds no
    more of the phrases of a stretch than these numbers.
    """
    prepare(df.sparkSession)
    ddl = "part bigint, kind int, mass bigint, keys binary, often binary"
    schema, flush = arrow_schema(ddl), FLUSH_BYTES

    def run(batches):
        for stretch in _stretches(batches, flush):
            found = []
            for _, _, sizes in stretch.phrases(longest):
                for gram in sizes:
                    seen = gram.counts > 0
                    found.append((gram.hashes[seen], gram.counts[seen].astype(np.uint32)))
            del sizes, gram, seen
            hashes, counts = map(np.concatenate, zip(*found))
            del found
            # By part, and in a part phrases found once behind the others: small numbers sort by their bytes.
            place = (hashes % np.uint64(partitions)).astype(np.min_scalar_type(2 * partitions)) * 2 + (counts == 1)
            order = np.argsort(place, kind="stable")
            part, counts = place[order] // 2, counts[order]
            keys = (hashes >> np.uint64(32)).astype(np.uint32)[order]
            del hashes, place, order
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
            ends, rows = np.append(starts[1:], len(part)), ([], [], [], [], [])
            for a, b in zip(starts.tolist(), ends.tolist()):
                many = a + int(np.count_nonzero(counts[a:b] > 1))
                mass = int(counts[a:b].sum(dtype=np.int64))
                for column, values in zip(rows, ([int(part[a])] * 2, [0, 1], [mass, 0], [b"", keys[a:b].tobytes()],
                                                 [b"", counts[a:many].tobytes()])):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return df.mapInArrow(run, ddl)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters; ``taken`` is what each lost at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        if len(keys):
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, counts = keys[starts], np.add.reduceat(counts, starts)
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, at)[at])
            keep = counts > cut
            keys, counts, self.taken = keys[keep], counts[keep] - cut, self.taken + cut
        self.keys, self.counts, self.waiting, self.size = keys, counts, [], 0

    def survivors(self, least: int) -> np.ndarray:
        """Keys that may have occurred ``least`` times."""
        self.merge()
        return self.keys[self.counts + self.taken >= least]


def survivors(packed: DataFrame, least: int) -> DataFrame:
    """(part, n, keys): the keys of each hash partition that may have occurred ``least`` times.

    The rows of a partition come in order, their masses first, so that the capacity is known before the
    first summary and only one merged summary is in memory.
    """
    ddl = "part bigint, n bigint, keys binary"
    schema = arrow_schema(ddl)

    def run(batches):
        part, mass, summary = None, 0, None

        def row():
            keys = summary.survivors(least) if summary else np.zeros(0, np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((part, len(keys), keys.tobytes()), schema)], schema=schema
            )

        pieces = (batch.slice(at, MERGE_ROWS) for batch in batches for at in range(0, batch.num_rows, MERGE_ROWS))
        for piece in pieces:
            for new, kind, more, keys, often in zip(*(piece.column(i).to_pylist() for i in range(5))):
                if new != part:
                    if part is not None:
                        yield row()
                    part, mass, summary = new, 0, None
                if kind == 0:
                    mass += more
                    continue
                summary = summary or Summary(mass // least + 1)
                keys, often = np.frombuffer(keys, np.uint32), np.frombuffer(often, np.uint32).astype(np.int64)
                summary.add(keys, np.append(often, np.ones(len(keys) - len(often), np.int64)))
        if part is not None:
            yield row()

    ordered = packed.repartition("part").sortWithinPartitions("part", "kind")
    return ordered.mapInArrow(run, ddl)


def _bit(part: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
    return part * width + (mix(key.astype(np.uint64)) % np.uint64(width)).astype(np.int64)


def bit_filter(found: DataFrame, partitions: int) -> tuple[np.ndarray, int]:
    """Bits of the surviving keys, a stretch of ``width`` bits per hash partition, and that width."""
    n = found.agg(F.sum("n")).first()[0] or 0
    width = max(8, min(BITS * -(-n // partitions), MOST_BITS // partitions)) // 8 * 8

    def run(batches):
        for batch in batches:
            rows = []
            for keys in batch.column("keys").to_pylist():
                bits = np.zeros(width, bool)
                bits[_bit(0, np.frombuffer(keys, np.uint32), width)] = True
                rows.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(rows, pa.binary())], names=["part", "bits"])

    out = np.zeros(partitions * width // 8, np.uint8)
    for part, bits in found.mapInArrow(run, "part bigint, bits binary").toLocalIterator(prefetchPartitions=True):
        out[part * width // 8 : (part + 1) * width // 8] = np.frombuffer(bits, np.uint8)
    return out, width


def exact_counts(df: DataFrame, bits: np.ndarray, width: int, partitions: int, longest: int) -> DataFrame:
    """(lang, size, phrase, n): occurrences of phrases that pass the filter; size 0 has those of all words."""
    prepare(df.sparkSession)
    ddl = "lang string, size int, phrase string, n bigint"
    schema, flush = arrow_schema(ddl), FLUSH_BYTES
    sent = df.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        held = sent.value

        def passes(hashes):
            part = (hashes % np.uint64(partitions)).astype(np.int64)
            bit = _bit(part, hashes >> np.uint64(32), width)
            return held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1

        def batch(lang, size, phrases, counts):
            arrays = [pa.array([lang] * len(phrases), pa.string()), pa.array(np.full(len(phrases), size, np.int32))]
            arrays += [pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for stretch in _stretches(batches, flush):
            names = list(stretch.numbers)
            for lang, n, sizes in stretch.phrases(longest, passes):
                yield batch(lang, 0, [b""], np.array([n]))
                sizes = list(sizes)
                for size, gram in enumerate(sizes, 1):
                    chosen = np.flatnonzero(gram.counts)
                    columns, at = [], chosen
                    for shorter in reversed(sizes[:size]):
                        columns.append([names[w] for w in shorter.last[at].tolist()])
                        at = shorter.before[at]
                    phrases = list(map(b" ".join, zip(*reversed(columns))))
                    for low in range(0, len(phrases), 8_192):
                        yield batch(lang, size, phrases[low : low + 8_192], gram.counts[chosen[low : low + 8_192]])

    return df.mapInArrow(run, ddl).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(df: DataFrame, lang_column: str, text_column: str, longest: int, least: int) -> DataFrame:
    """(lang, size, phrase, n) of all phrases with at least ``least`` occurrences; size 0: words of a language."""
    rows = df.select(F.coalesce(lang_column, F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_column).alias("text"))
    # A word takes two characters with the blank after it and begins one phrase of each size.
    most = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    partitions = max(PARTITIONS, most * longest // 2 // PARTITION_MASS)
    found = stored(survivors(summaries(rows, partitions, longest), least), "phrases-found")
    counted = exact_counts(rows, *bit_filter(found, partitions), partitions, longest)
    return stored(counted.filter((F.col("n") >= least) | (F.col("size") == 0)), "phrases-counted")


def _joined(words: Column, first, length) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (left right)) with 38 digits, exact for counts below 10^15."""
    wide = lambda c: c.cast("decimal(16,0)")
    top = wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")
    rest = top % (wide(left) * wide(right)).cast("decimal(38,0)")
    return ((top - rest) / (wide(left) * wide(right))).cast("bigint")


def mine(
    df: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    covered: int = COVERED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` collocations of each language.

    A phrase of 2 to ``longest`` words with ``a`` occurrences, at least ``least``, is scored at the cut
    that scores least; one that a longer candidate holds in ``covered`` percent of its occurrences is left
    out. A NULL language is ``und``, a NULL text empty; repeated rows count each time, and ties go by
    occurrences and then by the bytes of the phrase. Only the two named columns are read.
    """
    counts = phrase_counts(df, lang_column, text_column, longest, least)
    words = F.split("phrase", " ")
    candidates = counts.filter("size > 1").withColumnRenamed("n", "a")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns(
        {"first": _joined(words, F.lit(1), F.col("cut")), "rest": _joined(words, F.col("cut") + 1, F.col("size"))}
    )
    known = counts.filter("size > 0")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )
    inner = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    longer = candidates.filter("size > 2").withColumn("words", words).withColumn("width", inner)
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)))
    longer = longer.groupBy("lang", _joined(F.col("words"), F.col("at"), F.col("width")).alias("phrase"))
    longer = longer.agg(F.max("a").alias("within"))
    free = best.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("within") < covered * F.col("a"), F.lit(True))
    )
    order = [F.desc("best.score"), F.desc("a"), F.asc("phrase")]
    salted = free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order)))
    ranked = first.filter(F.col("place") <= top).withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")
    )
    totals = counts.filter("size = 0").select("lang", F.col("n"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )
