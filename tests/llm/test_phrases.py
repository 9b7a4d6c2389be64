"""Collocations against a plain count of all phrases, and the guarantee of the summaries."""

from __future__ import annotations

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from herdloom.llm import collocations
from herdloom.llm.catalog import op11_collocations
from tests.llm.conftest import SF, rows_of

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, longest=3, least=10, top=2000, covered=50):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    inside = collections.defaultdict(int)
    for (lang, words), a in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i : i + k]] = max(inside[lang, words[i : i + k]], a)
    by = collections.defaultdict(list)
    for (lang, words), a in frequent.items():
        if 100 * inside[lang, words] >= covered * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (
            (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
            for lang, held in by.items()
            for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1)
        ),
        key=repr,
    )


def test_query_equals_plain_version(spark, small):
    expected = plain_phrases([(r.lang, r.text) for r in small.collect()])
    assert expected and rows_of(op11_collocations(spark, SF), *COLUMNS) == expected


def test_edge_rows_and_empty_table(edge, none):
    expected = plain_phrases([(r.lang, r.text) for r in edge.collect()])
    assert rows_of(collocations.mine(edge), *COLUMNS) == expected
    assert collocations.mine(none).collect() == []


def test_ties_repeated_rows_and_languages(docs, monkeypatch):
    """Few partitions and small stretches, so that summaries overflow and merge."""
    monkeypatch.setattr(collocations, "FLUSH_BYTES", 2_000)
    rng = random.Random(3)
    words = ["A", "b", "ü", "Ü", "c\tc", "d.d", "e,", "f\x1cg", "日本", "a\nb", "x  x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None, "und"])) for i in range(300)]
    rows += [(7, "one and the same text, over and over again", "en")] * 40
    df = docs(*rows).repartition(5)
    plain = [(r[2], r[1]) for r in rows]
    assert rows_of(collocations.mine(df), *COLUMNS) == plain_phrases(plain)
    got = rows_of(collocations.mine(df, longest=4, least=5, top=7, covered=80), *COLUMNS)
    assert got == plain_phrases(plain, 4, 5, 7, 80)


def test_a_full_filter_changes_nothing(small, docs, monkeypatch):
    """Where the filter has no room it lets phrases pass, and the exact counts decide."""
    monkeypatch.setattr(collocations, "MOST_BITS", 8 * collocations.PARTITIONS)
    expected = plain_phrases([(r.lang, r.text) for r in small.collect()])
    assert rows_of(collocations.mine(small), *COLUMNS) == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=40), min_size=1, max_size=8), st.integers(2, 12))
def test_frequent_keys_survive_any_merging(parts, least):
    whole = collections.Counter(x for part in parts for x in part)
    summary = collocations.Summary(sum(whole.values()) // least + 1)
    for part in parts:
        keys, counts = np.unique(np.array(part, np.uint32), return_counts=True)
        summary.add(keys, counts)
        assert len(summary.keys) <= summary.capacity
    kept = set(summary.survivors(least).tolist())
    assert {k for k, n in whole.items() if n >= least} <= kept and summary.taken < least


def test_summaries_forget(spark, small):
    """Counters are fewer than phrases: most of those that occur once or twice are gone before the second pass."""
    rows = small.selectExpr("lang", "text")
    found = collocations.survivors(collocations.summaries(rows, 8, 3), 10)
    left = sum(r.n for r in found.collect())
    different = collections.Counter()
    for r in small.collect():
        words = collocations.words_of(r.text)
        different.update(zip(words, words[1:], words[2:]))
    assert left < len(different) / 4


def test_a_task_holds_few_bytes_per_byte_of_text(monkeypatch):
    """Memory of the first pass beyond its input, on texts that are one stretch with hardly a phrase twice."""
    monkeypatch.setattr(collocations, "prepare", lambda spark: None)
    monkeypatch.setattr(collocations, "FLUSH_BYTES", 1 << 22)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(1_000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})

    class Rows:
        sparkSession = None

        def mapInArrow(self, run, ddl):  # noqa: N802
            return list(run(iter([batch])))

    tracemalloc.start()
    try:
        found = collocations.summaries(Rows(), 64, 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sum(b.column("mass").to_pylist()) for b in found) == 1_000 * (500 + 499 + 498)
    assert peak < 24 * sum(map(len, texts)), peak / sum(map(len, texts))


def test_scores_pass_64_bits(spark):
    from pyspark.sql import functions as F

    rows = [(10**14 + 7, 10**14 + 9, 3 * 10**14), (10, 11, 12), (10, 10, 10), (7 * 10**12, 10**15 - 1, 7 * 10**12 + 1)]
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    got = df.select("a", "l", "r", collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in got)
