"""Personal data: pattern spans, and terms in the documents around them that reveal them by the corpus.

A protected entity is a value that a pattern finds; the documents of the corpus are the sample. The
information content of an entity is IC(e) = log N / n(e), and a term discloses PMI(t, e) =
log N n(t, e) / (n(t) n(e)) of it, from the numbers of documents in which they stand. A term whose
disclosure reaches a share of IC(e) stands for the entity nearly as well as the value itself; it is
generalised wherever it stands in a document with that entity, or removed where no other document uses it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import (
    arrow_schema,
    free_name,
    key_filter,
    map_batches,
    map_slices,
    passes,
    prepare,
    release,
    replaced,
    stored,
    texts,
)

# Kinds of the contract in their order, the kind this operator adds, and the patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ORDER = {kind: i for i, kind in enumerate((*BASE_KINDS, TERM))}
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")
SPAN_SIGN = re.compile("[@0-9]")

#: Different texts in which a term must stand with an entity, and the share of IC(e) it must disclose.
LEAST_TEXTS, DISCLOSURE = 3, 0.9
#: Characters that a term has at least.
LEAST_CHARS = 3
#: Different terms that a task counts in memory.
HELD_TERMS = 100_000
WORD = re.compile(r"[^\W_]+")
#: What stands in place of a span; a generalised term keeps only its shape.
PLACEHOLDER = {kind: f"<{kind.upper()}>" for kind in BASE_KINDS}
GENERAL_WORD, GENERAL_NUMBER = "<WORD>", "<NUMBER>"


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find_base(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the contract's patterns, by start and then kind.

    An address is sought from its @: its local part is the run before it, back to the last match. That
    and the look-behind before a number keep the time linear in runs of any length.
    """
    spans = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        match = EMAIL_DOMAIN.match(text, at) if start < at else None
        if match:
            free = match.end()
            spans.append((start, free, "email"))
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    spans += [(*m.span(), "ip") for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for match in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((*match.span(), "card"))
    for match in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
            spans.append((*match.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], ORDER[s[2]]))


def written(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def entity_of(text: str, span: tuple[int, int, str]) -> int:
    """Key of the value of a span, whatever its case and punctuation."""
    start, end, kind = span
    value = text[start:end].lower() if kind in ("email", "ip") else NOT_DIGIT.sub("", text[start:end])
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}") - (1 << 63)


def terms_of(text: str, spans) -> list[tuple[str, int, int]]:
    """All terms of a text that belong to no span, in lower case with their places; ``spans`` by start."""
    out, k, end = [], 0, 0
    for match in WORD.finditer(text):
        a, b = match.span()
        while k < len(spans) and spans[k][0] < b:
            end = max(end, spans[k][1])
            k += 1
        if end <= a and b - a >= LEAST_CHARS:
            out.append((match[0].lower(), a, b))
    return out


def mentions(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: key of the row and of its text, counts, base spans and different entities.

    Rows with an entity have all their terms with their places, as parallel lists.
    """
    ddl = (
        f"{id_column} bigint, row_key bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_spans string, text_key bigint, entities array<bigint>, "
        "terms array<string>, starts array<bigint>, ends array<bigint>"
    )

    def work(batch):
        out = [[] for _ in range(11)]
        for doc, text in zip(batch.column(id_column).to_pylist(), texts(batch, text_column)):
            spans = find_base(text)
            entities = sorted({entity_of(text, span) for span in spans})
            columns = list(map(list, zip(*terms_of(text, spans)))) if spans else []
            kinds = [s[2] for s in spans]
            values = (row_key(doc, text), *(kinds.count(k) for k in BASE_KINDS), written(spans), row_key("", text))
            values += (entities, *(columns or ([], [], [])))
            for column, value in zip(out, values):
                column.append(value)
        return [batch.column(id_column), *out]

    return map_slices(df.select(id_column, text_column), lambda: work, ddl)


def row_key(doc, text: str) -> int:
    """Key of a row for joins: rows with the same id and text have the same spans."""
    return xxhash.xxh3_64_intdigest(f"{doc}\n{text}".encode()) - (1 << 63)


def document_frequencies(df: DataFrame, text_column: str, wanted: np.ndarray | None = None) -> DataFrame:
    """(term, n): documents in which a term stands; a task counts ``HELD_TERMS`` terms before it passes them on.

    ``wanted``, a ``key_filter`` of terms, leaves out others; a task passes each of the rest on once, as long
    as these are fewer than ``HELD_TERMS``.
    """
    prepare(df.sparkSession)
    schema = arrow_schema("term string, n bigint")
    sent = None if wanted is None else df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        counts, held = Counter(), Counter()

        def sorted_out():
            """Counts so far go to those held, but for terms that are not wanted."""
            terms = list(counts)
            if sent is not None and terms:
                # The hash that Spark gives a text.
                hashes = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
                terms = [terms[i] for i in np.flatnonzero(passes(sent.value, hashes.view(np.int64)))]
            for term in terms:
                held[term] += counts[term]
            counts.clear()

        def passed_on():
            terms = list(held)
            for at in range(0, len(terms), 10_000):
                part = terms[at : at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([held[t] for t in part], pa.int64())], schema=schema
                )
            held.clear()

        for batch in batches:
            for text in texts(batch, text_column):
                # Words outside spans only, as next to an entity; without @ and digits there is no span.
                spans = find_base(text) if SPAN_SIGN.search(text) else []
                if spans:
                    counts.update({term for term, _, _ in terms_of(text, spans)})
                else:
                    counts.update({w.lower() for w in set(WORD.findall(text)) if len(w) >= LEAST_CHARS})
                if len(counts) >= HELD_TERMS:
                    sorted_out()
                    if len(held) >= HELD_TERMS:
                        yield from passed_on()
        sorted_out()
        yield from passed_on()
        release()

    parts = df.select(text_column).mapInArrow(run, "term string, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def members_of(single: DataFrame, least: int) -> DataFrame:
    """(entity, entities, n_e): entities in ``least`` different texts, with the key of their group.

    Entities that stand in the same texts, as those of one directory do, have the same counts with every
    term. They are one group, named by the least of them, and are never paired with terms one by one.
    """
    key = F.xxhash64("text_key")
    counted = single.groupBy("entity").agg(
        F.sum("copies").alias("n_e"), F.count("*").alias("n_texts"),
        F.bit_xor(key).alias("x"), F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("y"),
    )
    counted = stored(counted.filter(F.col("n_texts") >= least), "pii-entities")
    groups = counted.groupBy("x", "y", "n_e", "n_texts").agg(F.min("entity").alias("entities"))
    return counted.join(groups, ["x", "y", "n_e", "n_texts"]).select("entity", "entities", "n_e")


def revealing(
    df: DataFrame, found: DataFrame, text_column: str, least: int = LEAST_TEXTS, disclosure: float = DISCLOSURE
) -> tuple[DataFrame, DataFrame]:
    """(entities, term, alone) of terms that disclose a group of entities, by all documents of the corpus,
    and the groups as (entity, entities, n_e).

    A term must stand with the entity in ``least`` different texts, so copies of a text prove nothing, and
    chance meetings in one or two don't either: every rare word of these would disclose all. All counts are
    sums that tasks begin before the shuffle, so an entity or term in a third of all documents is a few
    rows per task. ``alone``: the term stands in no document without the entity.

    PMI of at least d IC means n(t) <= n(t, e) (N / n(e))^(1 - d), and n(t, e) is at most n(e). So documents
    are counted first, for terms in ``least`` texts with known entities, and a term meets an entity only
    where it is rare enough: common words are never paired.
    """
    holders = (
        found.filter(F.size("entities") > 0)
        .groupBy("text_key")
        .agg(F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    )
    holders = stored(holders.withColumn("terms", F.array_distinct("terms")), "pii-holders")
    single = holders.select("text_key", "copies", F.explode("entities").alias("entity"))
    members = stored(members_of(single, least), "pii-members")
    owned = single.join(members, "entity").groupBy("text_key").agg(F.collect_set(F.struct("entities", "n_e")).alias("owned"))
    holders = stored(holders.drop("entities").join(owned, "text_key"), "pii-owned")
    n_all, most = found.count(), members.agg(F.max("n_e")).first()[0] or 1

    def bound(n_e):
        # A little above the bound, as the logarithms below decide.
        return F.pow(n_e, F.lit(disclosure)) * F.lit(float(max(n_all, 1)) ** (1 - disclosure) * (1 + 1e-6))

    # A term stands in no fewer documents than it does in those with a known entity.
    candidates = holders.select("copies", F.explode("terms").alias("term")).groupBy("term")
    candidates = candidates.agg(F.count("*").alias("n_texts"), F.sum("copies").alias("n"))
    candidates = candidates.filter((F.col("n_texts") >= least) & (F.col("n") <= bound(F.lit(float(most))))).select("term")
    candidates = stored(candidates, "pii-candidates")
    counted = document_frequencies(df, text_column, key_filter(candidates, "term"))
    rare = counted.filter(F.col("n") <= bound(F.lit(float(most)))).withColumnRenamed("n", "n_t")
    rare = stored(rare.join(candidates, "term", "left_semi"), "pii-rare")
    pairs = holders.select("copies", "owned", F.explode("terms").alias("term")).join(rare, "term")
    near = F.filter("owned", lambda e: F.col("n_t") <= bound(e["n_e"].cast("double")))
    pairs = pairs.select("copies", "term", "n_t", F.explode(near).alias("e"))
    joint = pairs.groupBy("e.entities", "e.n_e", "term", "n_t").agg(F.sum("copies").alias("n_te"), F.count("*").alias("n_texts"))
    scored = joint.filter(F.col("n_texts") >= least).withColumns(
        {
            "ic": F.log(F.lit(n_all) / F.col("n_e")),
            "pmi": F.log(F.lit(n_all) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))),
        }
    )
    scored = scored.filter((F.col("ic") > 0) & (F.col("pmi") >= disclosure * F.col("ic")))
    return scored.select("entities", "term", (F.col("n_t") == F.col("n_te")).alias("alone")), members


def added_spans(found: DataFrame, terms: DataFrame, members: DataFrame) -> DataFrame:
    """(row_key, added): all places of revealing terms in rows with their entity, per row that has any.

    A place is written ``start:end:alone``; one that reveals several entities counts once. Rows meet groups
    of entities, and their places the terms; the two meet by row, so no place is repeated per entity.
    """
    rows = found.filter(F.size("entities") > 0)
    groups = rows.select("row_key", F.explode("entities").alias("entity")).join(members, "entity").select("row_key", "entities")
    groups = stored(groups.join(terms.select("entities").distinct(), "entities", "left_semi").distinct(), "pii-groups")
    some = rows.join(groups.select("row_key").distinct(), "row_key", "left_semi")
    places = some.select("row_key", F.explode(F.arrays_zip("terms", "starts", "ends")).alias("c")).select(
        "row_key", F.col("c.terms").alias("term"), "c.starts", "c.ends"
    )
    hits = places.join(terms, "term").join(groups, ["row_key", "entities"], "left_semi")
    one = hits.groupBy("row_key", "starts", "ends").agg(F.max("alone").alias("alone"))
    place = F.concat_ws(":", F.col("starts").cast("string"), F.col("ends").cast("string"), F.col("alone").cast("string"))
    return one.groupBy("row_key").agg(F.collect_list(place).alias("added"))


def _added(df: DataFrame, found: DataFrame, text_column: str) -> DataFrame:
    terms, members = revealing(df, found, text_column)
    return stored(added_spans(found, stored(terms, "pii-terms"), members), "pii-added")


def _places(added: list[str] | None) -> list[tuple[int, int, bool]]:
    split = (p.split(":") for p in added or [])
    return sorted((int(a), int(b), alone == "true") for a, b, alone in split)


def find_personal(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Personal data in every whole text: counts and digest of pattern spans, and all spans.

    One row per row of ``df``, repeated ones too; only the two named columns are read. A NULL or empty
    text has no span. Positions count code points, ends are exclusive. Texts are read twice, for spans
    and for document frequencies; only texts with an entity go through shuffles, as terms.
    """
    found = stored(mentions(df, id_column, text_column), "pii-mentions")
    added = _added(df, found, text_column)
    joined = found.select(
        id_column, "row_key", "n_email", "n_ip", "n_card", "n_phone", "base_spans"
    ).join(added, "row_key", "left")
    ddl = (
        f"{id_column} bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string"
    )

    def work(batch):
        base = batch.column("base_spans").to_pylist()
        spans = []
        for text, added in zip(base, batch.column("added").to_pylist()):
            own = [(int(a), int(b), kind) for kind, a, b in (s.split(":") for s in text.split(",") if s)]
            own += [(a, b, TERM) for a, b, _ in _places(added)]
            spans.append(written(sorted(own, key=lambda s: (s[0], ORDER[s[2]]))))
        digests = [hashlib.sha256(b.encode()).hexdigest() for b in base]
        counts = [batch.column(f"n_{kind}") for kind in BASE_KINDS]
        return [batch.column(id_column), *counts, digests, spans]

    return map_slices(joined, lambda: work, ddl)


def sanitised_text(text: str, added: list[str] | None) -> str:
    """The text with its spans replaced; overlapping spans become one, named after the first."""
    spans = [(a, b, PLACEHOLDER[kind]) for a, b, kind in find_base(text)]
    for a, b, alone in _places(added):
        general = GENERAL_NUMBER if any(c.isdigit() for c in text[a:b]) else GENERAL_WORD
        spans.append((a, b, "" if alone else general))
    parts, at = [], 0
    for start, end, place in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            parts += [text[at:start], place]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitise(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` with personal data in its texts replaced and revealing terms generalised or removed.

    All rows and columns stay, NULL texts too. The corpus is ``df`` itself.
    """
    found = stored(mentions(df, id_column, text_column), "pii-mentions")
    added = _added(df, found, text_column)
    key, places = free_name(df, "row_key"), free_name(df, "added")
    schema, columns = df.schema, df.columns

    def keyed(batch):
        docs = batch.column(id_column).to_pylist()
        keys = [row_key(doc, t) for doc, t in zip(docs, texts(batch, text_column))]
        return batch.append_column(key, pa.array(keys, pa.int64()))

    with_key = map_batches(df, lambda: keyed, f"{schema.simpleString()[7:-1]}, {key}: bigint")
    joined = with_key.join(added.select(F.col("row_key").alias(key), F.col("added").alias(places)), key, "left")

    def work(batch):
        old = batch.column(text_column).to_pylist()
        new = [t if t is None else sanitised_text(t, a) for t, a in zip(old, batch.column(places).to_pylist())]
        return replaced(batch.select(columns), text_column, pa.array(new, pa.string()))

    return map_batches(joined, lambda: work, schema)
