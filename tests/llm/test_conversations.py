"""Repair of conversations against a plain search over whole audits, and its parts by themselves."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from herdloom.llm import conversations
from herdloom.llm.catalog import op12_conversations
from tests.llm.conftest import SF, rows_of

DDL = "conv_id bigint, turn bigint, role string, text string, class int, n bigint, Edit string, kind string"
RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
MOVES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_audit(rows):
    """Cheapest audit by whole strings: rows are (role, faults); returns (cost, audit, repaired rows)."""
    best = {"": (0, "", ())}

    def offer(to, state, cost, audit, made):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, made)

    def insert(at):
        out = dict(at)
        for _ in range(3):
            for state, (cost, audit, made) in list(out.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in MOVES:
                        offer(out, MOVES[state, role[0]], cost + 3, audit + "I", (*made, f"{role}:"))
        return out

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, made) in insert(best).items():
            offer(after, state, cost + 4, audit + "D", made)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if not role or (state, role[0]) in MOVES:
                offer(after, MOVES[state, role[0]] if role else state, cost + more, audit + "K", (*made, f"{role}:{text}"))
            for other in ("user", "assistant"):
                if (state, other[0]) in MOVES:
                    offer(after, MOVES[state, other[0]], cost + 3 + more, audit + "R", (*made, f"{other}:{text}"))
        best = after
    return min(v for state, v in insert(best).items() if state in ("", "a"))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0, 1, 1, 2, 1)[fault] if fault < 5 else [(conv, turn, role, text)]
    return out


def plain_repair(ids, rows):
    """Results by conversation for rows already damaged."""
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    out = []
    for conv in set(ids):
        held = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, judged, counts = set(), [], collections.Counter()
        for _, role, text in held:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = None
            if not words:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif words[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        turns = {t for t, _, _ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        first = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit, made = plain_audit(judged)
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="session")
def turns(spark):
    def make(*rows):
        return spark.createDataFrame([tuple(r) + (None,) * 4 for r in rows], DDL)

    return make


ROLES = ["system", "user", "assistant", "tool", "", " ", None, "Σ"]


def random_rows(seed, n, conversations_, span=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "", " \t", None, "A longer text. And more?", "Yes. ", "ends in white space.\n\n"]
    ids = [None, *range(conversations_)]
    return [
        (rng.choice(ids), rng.choice([None, *range(span)]), rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), rng.choice(texts))
        for _ in range(n)
    ]


def test_query_equals_plain_version(spark):
    got = rows_of(op12_conversations(spark, SF), *RESULT)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == plain_repair([r[0] for r in rows], plain_damage(rows))


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(turns, seed):
    """Nulls in all columns, repeated rows and turns, odd roles, conversations that lose all rows."""
    rows = random_rows(seed, 400, 40)
    assert rows_of(conversations.repair_damaged(turns(*rows)), *RESULT) == plain_repair([r[0] for r in rows], plain_damage(rows))


def test_a_conversation_over_many_ranges(turns, spark):
    """Two long conversations, cut where ranges end, and one row repeated a thousand times."""
    rows = random_rows(7, 1_500, 1, span=10_000) + [(3, 5, "user", "The same row.")] * 1_000
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = turns(*rows).repartition(5)
        cut = conversations.segments(conversations.judged(conversations.damaged(df)))
        assert cut.filter("conv_id = 0").count() > 1
        assert rows_of(conversations.repair_damaged(df), *RESULT) == plain_repair([r[0] for r in rows], plain_damage(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)


def test_empty_table_and_conversation_without_rows(turns):
    assert conversations.repair_damaged(turns()).collect() == []
    key = next(i for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert rows_of(conversations.repair_damaged(turns((key, 0, "user", "Gone."))), *RESULT) == [(key, 0, 0, 0, 0, 0, 0, "", empty)]


def test_very_long_texts_and_extreme_turns(turns):
    rows = [(1, -(1 << 63), "user", "x. " * 200_000), (1, (1 << 63) - 1, "assistant", "y" * 300_000 + "!"), (2, 1, "u" * 50_000, "Hm.")]
    got = rows_of(conversations.repair_damaged(turns(*rows)), *RESULT)
    plain = [(c, conversations.wrapped(g), *more) for c, g, *more in plain_repair([1, 2], plain_damage(rows))]
    assert got == sorted(plain, key=repr)


def test_repaired_rows_follow_the_audit(turns):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "Well?")]
    made, found = conversations.repair(turns(*rows))
    audit = found.first().audit
    expected = plain_audit([(r, t, f) for (_, _, r, t), f in zip(rows, [None, None, None, "duplicate", None])])
    assert (found.first().cost, audit) == expected[:2]
    lines = [f"{r.role}:{r.text}" for r in sorted(made.collect(), key=lambda r: r.place)]
    assert tuple(lines) == expected[2] and re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from([None, None, "blank", "truncated"])), max_size=12), st.integers(0, 12))
def test_segments_put_together_equal_one_pass(rows, cut):
    parts, cut = [], min(cut, len(rows))
    for i, part in enumerate((rows[:cut], rows[cut:])):
        segment = conversations.Segment(i == 0)
        for role, fault in part:
            segment.add(None, role[:1], 1, fault == "blank", fault == "truncated", True)
        if part:
            parts.append(segment.row())
    got = conversations.together(parts)
    assert (got["cost"], got["audit"]) == plain_audit([(role, "x", fault) for role, fault in rows])[:2]


@given(st.lists(st.text("DIKR", max_size=9), min_size=2, max_size=8), st.sampled_from([97, (1 << 61) - 1]))
def test_prefixes_compare_like_strings(words, modulus):
    """With a tiny modulus hashes collide all the time, and equal hashes must prove nothing."""
    held, conversations.MODULUS = conversations.MODULUS, modulus
    try:
        prefixes, nodes = conversations.Prefixes(), []
        for word in words:
            node = 0
            for edit in word:
                node = prefixes.extend(node, edit)
            nodes.append(node)
            assert prefixes.text(node) == word
        for a, x in zip(words, nodes):
            for b, y in zip(words, nodes):
                assert (x == y) == (a == b) and (x == y or prefixes.less(x, y) == (a < b))
    finally:
        conversations.MODULUS = held
