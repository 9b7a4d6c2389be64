"""Operators over whole tables against plain versions of the contract."""

from __future__ import annotations

import collections
import os
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from herdloom.llm import base, host_rules, jaccard, quality_model, sharding
from tests.llm.conftest import SF, rows_of

# --- shards --------------------------------------------------------------------------------------


def plain_capacity(sizes, shards):
    """Least capacity by trying all places of all cuts."""
    best = {0: 0}
    for _ in range(shards):
        following = {}
        for start, worst in best.items():
            for end in range(start, len(sizes) + 1):
                value = max(worst, sum(sizes[start:end]))
                following[end] = min(value, following.get(end, value))
        best = following
    return best[len(sizes)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=14), st.integers(1, 6))
def test_cuts_keep_the_least_capacity(sizes, shards):
    capacity = sharding.least_capacity(sizes, shards)
    assert capacity == plain_capacity(sizes, shards)
    at = [0, *sharding.cuts(sizes, shards), len(sizes)]
    assert at == sorted(at) and max(sum(sizes[a:b]) for a, b in zip(at, at[1:])) == capacity


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 1_000), max_size=30), st.integers(1, 12))
def test_no_shard_is_empty_while_atoms_remain(sizes, shards):
    at = [0, *sharding.cuts(sizes, shards), len(sizes)]
    assert sum(a < b for a, b in zip(at, at[1:])) == min(len(sizes), shards)


@pytest.mark.parametrize("part", [3, 8])
def test_an_atom_above_the_equal_share_leaves_the_others_even(part):
    rest = [10] * 60_000
    heavy = sum(rest) // (part - 1)
    at = [0, *sharding.cuts([heavy, *rest], 24), len(rest) + 1]
    first, *others = (sum([heavy, *rest][a:b]) for a, b in zip(at, at[1:]))
    assert first == heavy and all(abs(o - sum(rest) / 23) <= 10 for o in others)


def check_shards(df, shards):
    got = sharding.assign_shards(df, shards).collect()
    source = df.select("doc_id", "text").collect()
    assert len(got) == len(source)
    expected = sorted(((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in source), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == expected
    slots = collections.defaultdict(list)
    by_text = collections.defaultdict(set)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values())
    return got


def test_shards_of_documents(spark, edge, none):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check_shards(documents, 5)
    bytes_by = collections.Counter()
    for r in got:
        bytes_by[r.shard] += r.size
    mean = sum(bytes_by.values()) / 5
    assert all(abs(b - mean) < 0.02 * mean for b in bytes_by.values())
    check_shards(edge, 24)
    assert sharding.assign_shards(none, 24).count() == 0


def test_shards_number_rows_in_chunks(docs, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 20)
    check_shards(docs(*((i, "hot" if i % 3 else f"text {i}") for i in range(300))), 4)


def test_shards_beside_a_large_group_of_copies_are_even(docs):
    rows = [(i, f"text number {i:06}" if i % 3 else "a text that a third hold") for i in range(6_000)]
    bytes_by = collections.Counter()
    for r in check_shards(docs(*rows), 24):
        bytes_by[r.shard] += r.size
    sizes = sorted(bytes_by.values())
    fair = sum(sizes[:-1]) / 23
    assert len(sizes) == 24 and all(abs(b - fair) < 0.05 * fair for b in sizes[:-1])


# --- similarity join -----------------------------------------------------------------------------


def plain_join(rows):
    sets = []
    for _, text in rows:
        words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        sets.append(grams)
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= 75 * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def near_copies(seed, texts, copies, words):
    """Texts of different lengths and copies of them with ever more words changed."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(texts):
        size = max(1, int(rnd.choice(words) * rnd.uniform(0.8, 1.2)))
        base = [f"w{rnd.randrange(2_000)}" for _ in range(size)]
        for _ in range(rnd.randint(1, copies)):
            own = list(base)
            for _ in range(rnd.randrange(1 + max(2, size // 25))):
                at = rnd.randrange(len(own))
                own[at : at + rnd.randrange(2)] = [f"n{rnd.randrange(10**6)}"]
            rows.append(" ".join(own[: rnd.choice([len(own)] * 3 + [max(1, int(0.85 * len(own)))])]))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words", [(1, 2, 4, 5, 6, 7), (8, 9, 10, 11, 12, 15), (30, 60, 64, 70, 90), (150, 320, 700)])
def test_join_equals_plain_join(docs, words):
    rows = near_copies(sum(words), 25, 6, words)
    got = jaccard.link(docs(*rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_join(rows)


def _clusters(monkeypatch):
    """Classes of each cluster that comes to be compared, as lists, filled by a join."""
    found, original = [], jaccard.verified_edges

    def verified(sets, percent):
        found.append(sorted(r["count"] for r in sets.groupBy("cluster").count().collect()))
        return original(sets, percent)

    monkeypatch.setattr(jaccard, "verified_edges", verified)
    return found


@pytest.mark.parametrize("size", [50, 400])
def test_a_line_that_many_texts_have_joins_no_candidates(docs, monkeypatch, size):
    """Near copies with the line stay a cluster of their own beside texts that are little else, which form one."""
    rnd, line = random.Random(size), " ".join(f"line{i}" for i in range(size // 5))
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    rows = [f"{text} {line}{end}" for text in (own(size) for _ in range(20)) for end in ("", " and")]
    rows = list(enumerate(rows + [f"{line} {own(3)}" for _ in range(10)]))
    clusters = _clusters(monkeypatch)
    got = jaccard.link(docs(*rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_join(rows)
    assert clusters == [[2] * 20 + [10]]


def test_one_of_each_pair_with_a_common_line_stays(docs, monkeypatch):
    rnd, line = random.Random(7), " ".join(f"line{i}" for i in range(12))
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(n)) for n in [60] * 12 + [3] * 8]
    rows = [(i, f"{text} {line}", None, "a") for i, text in enumerate(texts)]
    rows += [(100 + i, f"{text} {line} and", None, "b") for i, text in enumerate(texts[:12])]
    clusters = _clusters(monkeypatch)
    assert rows_of(jaccard.keep_one(docs(*rows)), "doc_id", "text", "source") == sorted([(r[0], r[1], r[3]) for r in rows[:20]], key=repr)
    assert clusters == [[2] * 12 + [8]]


def test_texts_that_only_equal_ones_resemble_are_no_candidates(docs, monkeypatch):
    rows = list(enumerate([f"short{i // 2} text" for i in range(20)] + [f"now six words of number {i}" for i in range(20)]))
    clusters = _clusters(monkeypatch)
    assert rows_of(jaccard.link(docs(*rows)), "doc_id", "n_shingles", "component_id") == plain_join(rows)
    assert clusters == [[]]


def test_files_that_are_read_no_more_are_removed(spark):
    frame = base.stored(spark.range(10).repartition(2), "test-discard")
    folder = frame.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert os.path.exists(folder)
    base.discard(frame)
    assert not os.path.exists(folder)


@pytest.mark.parametrize("limit", [("BLOCK", 16), ("BLOCK_ELEMENTS", 1_500)])
def test_join_of_a_large_group_in_blocks(docs, monkeypatch, limit):
    monkeypatch.setattr(jaccard, *limit)
    rows = near_copies(5, 2, 120, (80,)) + [(1_000 + i, f"lone text number {i} of its own kind {i}") for i in range(5)]
    assert rows_of(jaccard.link(docs(*rows)), "doc_id", "n_shingles", "component_id") == plain_join(rows)


def test_sets_with_too_few_segments_are_compared_with_all(docs, monkeypatch):
    rows = near_copies(3, 12, 5, (70, 100, 130))
    monkeypatch.setattr(jaccard.Bands, "__init__", _scarce(jaccard.Bands.__init__))
    assert rows_of(jaccard.link(docs(*rows)), "doc_id", "n_shingles", "component_id") == plain_join(rows)


def _scarce(original):
    def init(self, percent=jaccard.PERCENT):
        original(self, percent)
        self.segments = [m if m < 1 else max(2, m // 4) for m in self.segments]

    return init


def test_roles_meet_in_the_band_of_the_smaller_set():
    bands = jaccard.Bands()
    for n in [*range(1, 400), 999, 1_000, 5_000]:
        for m in range(n, jaccard.largest_partner(n) + 1):
            need = {band: d for band, d in bands.roles(m)}
            band = bands.of(n)
            assert band in need and need[band] > jaccard.most_different(n, m)
            assert dict(bands.roles(n))[band] > jaccard.most_different(n, m)


def test_join_of_edge_rows(edge, none):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert rows_of(jaccard.link(edge), "doc_id", "n_shingles", "component_id") == plain_join(rows)
    assert jaccard.link(none).count() == 0 and jaccard.keep_one(none).count() == 0
    kept = jaccard.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 1


def test_one_row_of_each_component_stays(docs):
    rows = near_copies(8, 15, 6, (20, 60))
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs(*rows)).collect())
    assert kept == sorted({component for _, _, component in plain_join(rows)})


def test_texts_that_share_an_id_are_judged_apart(docs):
    """What stands under the id of a copy is lost with no copy; rows without an id leave one, too."""
    a, b, c = ("a text of its own that nobody else has got", "a text that two rows of the table have", "one without any id at all but twice")
    kept = rows_of(jaccard.keep_one(docs((1, b), (5, b), (5, a), (None, c), (None, c), (7, c + " "), (None, None), (None, ""))), "doc_id", "text")
    assert kept == sorted([(1, b), (5, a), (7, c + " "), (None, None), (None, "")], key=repr)
    kept = rows_of(jaccard.keep_one(docs((None, c), (None, c), (3, a), (3, a), (3, b), (2, b))), "doc_id", "text")
    assert kept == sorted([(None, c), (3, a), (2, b)], key=repr)


def test_a_full_filter_loses_nothing(docs, monkeypatch):
    """With the least bits nearly all rows pass the filter, and the joins decide."""
    monkeypatch.setattr(base, "LEAST_FILTER", 3)
    monkeypatch.setattr(base, "MOST_FILTER", 3)
    rows = near_copies(5, 15, 6, (20, 60))
    assert rows_of(jaccard.link(docs(*rows)), "doc_id", "n_shingles", "component_id") == plain_join(rows)
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs(*rows)).collect())
    assert kept == sorted({component for _, _, component in plain_join(rows)})


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a bigint, b bigint")
    found = dict(rows_of(jaccard.components(edges)))
    assert found == {**dict.fromkeys(range(201), 0), 900: 900, 901: 900}


# --- quality model -------------------------------------------------------------------------------


def test_scores_tell_held_out_labels_apart(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_model.score_documents(documents, labels).join(labels, "doc_id")
    held = scored.filter("pmod(crc32(cast(doc_id as string)), 3) = 1").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in held)


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, len(quality_model.FEATURES)))
    trees = quality_model.fit(rows, (rows[:, 0] + rows[:, 3] * rows[:, 4] > 0).astype(float))

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(rows), [walk(r) for r in rows])


def test_scores_of_edge_rows(spark, edge, none):
    labels = spark.createDataFrame([(2, 0, 0), (5, 1, 0), (7, 1, None), (10, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    scored = quality_model.score_documents(edge, labels)
    assert scored.count() == edge.count() and scored.filter("score is null or predicted is null").count() == 0
    nothing = labels.limit(0)
    assert {r.score for r in quality_model.score_documents(edge, nothing).collect()} == {0.5}
    assert quality_model.score_documents(none, labels).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark, small):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (rows_of(quality_model.score_documents(small, table)) for table in (labels, flipped))
    assert a == b


# --- host rules ----------------------------------------------------------------------------------


def plain_counts(text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    grams = list(zip(words, words[1:], words[2:]))
    often, covered = collections.Counter(grams), set()
    for i, gram in enumerate(grams):
        if often[gram] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


TEXTS = ["a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z ", "## $ <b> | é", "a b\tc\x0bd\x0ce\r\nf a b c", "one", "one two", "é日 本 é日 本 é日 本", "a\x1cb \xa0c",
         " ".join(f"w{i}" for i in range(60)), "p q r " + " ".join(f"v{i}" for i in range(50)) + " p q r q r v0"]


def test_counts_equal_plain_counts(docs, edge, none):
    df = docs(*enumerate(TEXTS)).union(edge)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for r in df.collect():
        counts = plain_counts(r.text)
        expected.append((r.doc_id, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert rows_of(host_rules.judge(df), *columns) == sorted(expected, key=repr)
    assert host_rules.judge(none).count() == 0


def test_bad_hosts_take_their_documents_along_and_small_ones_are_shrunk(docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short" if i % 10 else good, None, "bad") for i in range(200)]
    rows += [(1_000 + i, "short" if i % 10 == 0 else good, None, f"host{i // 100}") for i in range(2_000)]
    rows += [(5_000, "short", None, "tiny"), (5_001, good, None, "tiny"), (5_002, good, None, None)]
    judged = {r.doc_id: r for r in host_rules.judge(docs(*rows)).collect()}
    assert all(judged[i].host_failed and not judged[i].kept for i in range(200))
    assert not any(judged[i].host_failed for i in [*range(1_000, 3_000), 5_000, 5_001, 5_002])
    assert judged[5_001].kept and judged[5_002].kept and not judged[5_000].kept
