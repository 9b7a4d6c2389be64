"""Benchmark decontamination: multi-pattern search over words with shift tables and suffix buckets."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import free_name, map_batches, map_slices, replaced, stored, texts

#: Words in a window of a benchmark item.
WINDOW = 13
#: Words of a block, on which the shift table is kept.
BLOCK = 2
#: Characters of benchmark text whose windows one pass over the documents searches; the rest in further passes.
SCANNER_CHARS = 4_000_000

# Bytes that are no part of a word become blanks, A-Z become a-z, all else stays.
_IS_WORD = [0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)]
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if ok else 0x20 for b, ok in enumerate(_IS_WORD))


def words_of(text: str) -> list[bytes]:
    """Words in order. Bytes from 0x80 on are part of words, so that whole code points stay together."""
    return text.encode().translate(FOLD).split()


def windows_of(words: list[bytes]) -> list[tuple[bytes, ...]]:
    if len(words) <= WINDOW:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)]


class Scanner:
    """Wu-Manber search for patterns of words that share a range of lengths.

    Let m be the least length. ``shift`` has for each block of words how far the search may move on so
    that no occurrence is stepped over: blocks that end none of the first m words of any pattern allow a
    jump. A block with shift 0 names, by the words it ends on, the few patterns to compare directly.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], set[int]]):
        self.least = m = min(map(len, patterns))
        self.block = block = min(BLOCK, m)
        self.default = m - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = defaultdict(dict)
        for pattern, items in patterns.items():
            for end in range(block, m + 1):
                key = pattern[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets[pattern[m - block : m]].setdefault(pattern[:m], []).append((pattern, items))

    def search(self, words: list[bytes], hit: bytearray, found: set[int]) -> None:
        """Mark the words of every occurrence in ``hit`` and add the items it belongs to."""
        m, block, n = self.least, self.block, len(words)
        shift, default, buckets = self.shift.get, self.default, self.buckets
        end = m
        while end <= n:
            key = tuple(words[end - block : end])
            step = shift(key, default)
            if step:
                end += step
                continue
            start = end - m
            for pattern, items in buckets[key].get(tuple(words[start:end]), ()):
                size = len(pattern)
                if size == m or tuple(words[start : start + size]) == pattern:
                    hit[start : start + size] = b"\1" * size
                    found.update(items)
            end += 1


def scanners(items: list[tuple[int, str | None]]) -> list[Scanner]:
    """Scanners for windows of full length and, apart so that they don't shorten its jumps, for short items."""
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = defaultdict(dict)
    for item, text in items:
        for window in windows_of(words_of(text or "")):
            group = WINDOW if len(window) == WINDOW else 1 << (len(window).bit_length() - 1)
            by_length[group].setdefault(window, set()).add(item)
    return [Scanner(patterns) for _, patterns in sorted(by_length.items(), reverse=True)]


def benchmark_blocks(benchmark: DataFrame, chars: int | None = None) -> Iterator[tuple[bool, list[tuple[int, str | None]]]]:
    """The benchmark in blocks of about ``chars`` characters, each with whether it is the last.

    A block is fetched when it is asked for, so the driver and the tasks hold one at a time.
    """
    table = benchmark.select("item_id", "text")
    total = table.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / (chars or SCANNER_CHARS)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield k == parts - 1, [tuple(r) for r in table.filter(part == k).toLocalIterator()]


def _marked(df: DataFrame, benchmark: DataFrame, text_column: str) -> tuple[DataFrame, str, str]:
    """``df`` with two more columns: a byte per word, 1 where it is hit (empty: none), and the items found.

    A benchmark above ``SCANNER_CHARS`` is searched block by block, and the marks are written to the
    shared folder before the next block is fetched.
    """
    marks, found = free_name(df, "marks"), free_name(df, "found")
    out = df.withColumns({marks: F.lit(b""), found: F.array().cast("array<bigint>")})
    for last, block in benchmark_blocks(benchmark.filter(F.col("item_id").isNotNull())):
        sent = df.sparkSession.sparkContext.broadcast(block)
        out = _search_block(out, sent, text_column, marks, found)
        if not last:
            out = stored(out, "marks")
            sent.unpersist()
        del block
    return out, marks, found


def _search_block(df: DataFrame, sent, text_column: str, marks: str, found: str) -> DataFrame:
    """Marks and items of one block, a broadcast, added to those of the blocks before."""

    def make():
        machines = scanners(sent.value)

        def work(batch):
            new_marks, new_found = [], []
            before = (batch.column(c).to_pylist() for c in (marks, found))
            for text, mark, items in zip(texts(batch, text_column), *before):
                words, items = words_of(text), set(items)
                hit = bytearray(mark or len(words))
                for machine in machines:
                    machine.search(words, hit, items)
                new_marks.append(bytes(hit) if any(hit) else b"")
                new_found.append(sorted(items))
            batch = replaced(batch, marks, pa.array(new_marks, pa.binary()))
            return replaced(batch, found, pa.array(new_found, pa.list_(pa.int64())))

        return work

    return map_batches(df, make, df.schema)


def _verdicts(batch: pa.RecordBatch, text_column: str, marks: str) -> tuple[list[int], list[int], list[bool]]:
    n_words = [len(words_of(t)) for t in texts(batch, text_column)]
    n_hit = [sum(mark) for mark in batch.column(marks).to_pylist()]
    return n_words, n_hit, [h > 0 and 20 * h >= n for h, n in zip(n_hit, n_words)]


def search(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Benchmark windows in every whole text.

    Returns per row of ``df``, repeated ones too: the id, ``n_words``, ``n_hit`` (words inside an
    occurrence), ``n_items`` and ``item_ids`` (items with an occurrence, sorted as texts), their digest
    and ``contaminated`` (at least one word in twenty is hit). NULL and empty texts have no words. An
    item without words or id matches nothing. Equal items are reported together, other columns not read.
    """
    marked, marks, found = _marked(df.select(id_column, text_column), benchmark, text_column)
    ddl = (
        f"{id_column} bigint, n_words bigint, n_hit bigint, n_items bigint, item_ids array<string>, "
        "items_sha256 string, contaminated boolean"
    )

    def work(batch):
        n_words, n_hit, bad = _verdicts(batch, text_column, marks)
        items = [sorted(map(str, ids)) for ids in batch.column(found).to_pylist()]
        digests = [hashlib.sha256(",".join(ids).encode()).hexdigest() for ids in items]
        return [batch.column(id_column), n_words, n_hit, [len(ids) for ids in items], items, digests, bad]

    return map_slices(marked, lambda: work, ddl)


def without_contaminated(df: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """Rows of ``df`` whose text is not contaminated, with all their columns as they are.

    Rows are judged one by one, so that repeated and NULL ids need no key.
    """
    marked, marks, _ = _marked(df, benchmark, text_column)
    columns = df.columns

    def work(batch):
        bad = _verdicts(batch, text_column, marks)[2]
        return batch.filter(pa.array([not b for b in bad])).select(columns)

    return map_batches(marked, lambda: work, df.schema)
