"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with frozen counts. The code length
of a byte is that of the escapes from longer contexts that have not seen it plus that of the byte in the
first context that has; a text belongs to the language that codes it, and the choice of the language,
in the fewest bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import ARROW, id_remainder, map_batches, map_slices, prepare, texts

#: Bytes of the longest context; a context and the byte after it make a key of ORDER + 1 bytes.
ORDER = 3
#: Documents per language that the counts are taken from: a bounded sample by hash of the id.
SAMPLE_DOCS = 2_500
#: Bytes that score at a time, which bounds the memory of a task whatever the length of a text.
CHUNK = 1 << 18
#: Texts stand after this many line breaks, so that their first bytes have a context too.
LEAD = b"\n" * ORDER
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def keys_of(data: np.ndarray) -> np.ndarray:
    """For each byte from the fourth on, it and the three before it as one number, latest byte lowest."""
    wide = data.astype(np.uint32)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


class Model:
    """Code lengths in bits of every seen context and byte, for all languages side by side."""

    def __init__(self, langs: list[str], docs: list[int], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        n = len(langs)
        share = np.array(docs, float) / max(1, sum(docs))
        self.choice = -np.log2(share) if n else np.zeros(0)
        # bits[k]: code lengths of all keys of k context bytes and one byte, by any language
        lower = np.full((256, n), 8.0)
        seen = [self._orders(keys, count) for keys, count in counts]
        for k in range(2):  # no context, then one byte: all keys fit into a table
            table = np.empty((256 ** (k + 1), n))
            for lang in range(n):
                table[:, lang] = self._level(seen[lang][k], np.arange(256 ** (k + 1)), lower[:, lang], k)
            lower = table if k == 1 else np.tile(table, (256, 1))
        self.low = lower.astype(np.float32)
        self.keys, self.bits, self.contexts, self.escapes = [], [], [], []
        for k in (2, 3):
            keys = np.unique(np.concatenate([s[k][0] for s in seen])) if n else np.zeros(0, np.uint32)
            bits = np.empty((len(keys), n), np.float32)
            contexts = np.unique(keys >> 8)
            escapes = np.zeros((len(contexts), n), np.float32)
            below = self._lookup(k - 1, keys & np.uint32(256**k - 1)) if len(keys) else bits
            for lang in range(n):
                bits[:, lang], escapes[:, lang] = self._seen_level(seen[lang][k], keys, contexts, below[:, lang])
            self.keys.append(keys)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escapes.append(escapes)
        self._index()

    def __getstate__(self):
        """Without the table of places, which each task builds for itself."""
        return {k: v for k, v in self.__dict__.items() if k not in ("pair", "place", "full")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._index()

    @staticmethod
    def _orders(keys: np.ndarray, count: np.ndarray):
        """Counts by the last 1, 2, 3 and 4 bytes of the keys."""
        out = []
        for k in range(ORDER + 1):
            short = keys & np.uint32(256 ** (k + 1) - 1)
            unique, inverse = np.unique(short, return_inverse=True)
            out.append((unique, np.bincount(inverse, count, len(unique))))
        return out

    @staticmethod
    def _escape(unique: np.ndarray, count: np.ndarray):
        """Of each context: bytes after it, different ones among them, and the index of each key's context."""
        contexts, at = np.unique(unique >> 8, return_inverse=True)
        return contexts, np.bincount(at, count, len(contexts)), np.bincount(at, minlength=len(contexts)), at

    def _level(self, seen, keys, lower, k):
        unique, count = seen
        contexts, total, kinds, at = self._escape(unique, count)
        bits = lower[keys % len(lower)] if k else lower[keys].copy()
        escape = np.zeros(256**k)
        escape[contexts] = np.log2((total + kinds) / kinds)
        bits = bits + escape[keys >> 8]
        bits[unique] = np.log2((total[at] + kinds[at]) / count)
        return bits

    def _seen_level(self, seen, keys, contexts, lower):
        """Code lengths of ``keys`` and of the escapes from ``contexts`` for one language."""
        unique, count = seen
        own, total, kinds, at = self._escape(unique, count)
        escape = np.zeros(len(contexts))
        escape[np.searchsorted(contexts, own)] = np.log2((total + kinds) / kinds)
        bits = lower + escape[np.searchsorted(contexts, keys >> 8)]
        bits[np.searchsorted(keys, unique)] = np.log2((total[at] + kinds[at]) / count)
        return bits, escape

    def _lookup(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Code lengths of any keys of k context bytes and one byte."""
        if k == 1:
            return self.low[keys]
        known, bits = self.keys[k - 2], self.bits[k - 2]
        at = np.searchsorted(known, keys)
        hit = known[at.clip(max=len(known) - 1)] == keys
        out = np.empty((len(keys), len(self.langs)), np.float32)
        out[hit] = bits[at[hit]]
        rest = keys[~hit]
        if len(rest):
            contexts, escapes = self.contexts[k - 2], self.escapes[k - 2]
            place = np.searchsorted(contexts, rest >> 8).clip(max=len(contexts) - 1)
            out[~hit] = self._lookup(k - 1, rest & np.uint32(256**k - 1)) + np.where(
                (contexts[place] == rest >> 8)[:, None], escapes[place], 0
            )
        return out

    def _index(self) -> None:
        """Number the byte pairs in use, so that full keys are found in a table instead of by search."""
        keys = self.keys[1]
        pairs = np.unique(np.concatenate([keys >> 16, keys & 0xFFFF])) if len(keys) else keys
        self.pair = np.zeros(65_536, np.int64)
        self.pair[pairs] = np.arange(1, len(pairs) + 1)
        self.width = len(pairs) + 1
        self.place = np.zeros(self.width * self.width, np.int32)
        self.place[self.pair[keys >> 16] * self.width + self.pair[keys & 0xFFFF]] = np.arange(1, len(keys) + 1)
        self.full = np.vstack([np.zeros((1, len(self.langs)), np.float32), self.bits[1]])

    def code_lengths(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte after the third, by language."""
        wide = data.astype(np.int64)
        pair = self.pair[wide[:-1] << 8 | wide[1:]]
        at = self.place[pair[:-2] * self.width + pair[2:]]
        bits = self.full[at]
        rest = np.flatnonzero(at == 0)
        if len(rest):
            keys = (wide[rest] << 24 | wide[rest + 1] << 16 | wide[rest + 2] << 8 | wide[rest + 3]).astype(np.uint32)
            bits[rest] = self._lookup(ORDER, keys)
        return bits

    def totals(self, items: list[bytes]) -> np.ndarray:
        """Bits of whole texts by language."""
        out = np.zeros((len(items), len(self.langs)))
        group, size = [], 0
        for i, item in enumerate(items):
            for start in range(0, len(item), CHUNK):
                lead = LEAD if not start else item[start - ORDER : start]
                group.append((i, lead + item[start : start + CHUNK]))
                size += len(group[-1][1])
                if size >= CHUNK:
                    self._add(group, out)
                    group, size = [], 0
        if group:
            self._add(group, out)
        return out

    def _add(self, group: list[tuple[int, bytes]], out: np.ndarray) -> None:
        data = np.frombuffer(b"".join(piece for _, piece in group), np.uint8)
        bits = self.code_lengths(data)
        ends = np.cumsum([len(piece) for _, piece in group])
        starts = np.r_[0, ends[:-1]]
        for (i, _), a, b in zip(group, starts.tolist(), ends.tolist()):
            out[i] += bits[a : b - ORDER].sum(0, dtype=np.float64)

    def predict(self, items: list[str]) -> tuple[list[str], list[float]]:
        """Language and its share of the probability that all languages give a text."""
        if not self.langs:
            return [UNDETERMINED] * len(items), [0.0] * len(items)
        bits = self.totals([t.encode() for t in items]) + self.choice
        best = bits.argmin(1)
        share = 1 / np.exp2((bits.min(1)[:, None] - bits).clip(-1000)).sum(1)
        known = [LETTER.search(t) is not None for t in items]
        names = [self.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), known)]
        return names, [s if ok else 0.0 for s, ok in zip(share.tolist(), known)]


def train(df: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Frozen statistics from (doc_id, text, lang) of labelled rows.

    Of each language about ``sample_docs`` documents count, picked by the hash of their id; with fewer,
    all do. Tasks count keys of their rows and the sums of a key meet in a shuffle; what reaches the
    driver is bounded by the sample.
    """
    labelled = df.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], [], [])
    langs = sorted(sizes)
    share = {lang: min(1.0, sample_docs / sizes[lang]) for lang in langs}
    point = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000.0
    limit = F.element_at(F.create_map(*(F.lit(x) for lang in langs for x in (lang, share[lang]))), F.col("lang"))
    picked = labelled.filter(point < limit)
    number = {lang: i for i, lang in enumerate(langs)}
    schema = pa.schema([("lang", ARROW["int"]), ("key", ARROW["bigint"]), ("n", ARROW["bigint"])])
    prepare(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for text, lang in zip(texts(batch), batch.column("lang").to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(LEAD + text.encode())
            for lang, items in by_lang.items():
                data = np.frombuffer(b"".join(items), np.uint8)
                keep = np.ones(len(data) - ORDER, bool)
                for end in np.cumsum([len(i) for i in items])[:-1].tolist():
                    keep[end - ORDER : end] = False
                keys, n = np.unique(keys_of(data)[keep], return_counts=True)
                lang_column = pa.array(np.full(len(keys), number[lang], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [lang_column, pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], schema=schema
                )

    counted = picked.mapInArrow(count, "lang int, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    lang, key, n = (table.column(c).to_numpy() for c in ("lang", "key", "n"))
    counts = [(key[lang == i].astype(np.uint32), n[lang == i].astype(float)) for i in range(len(langs))]
    return Model(langs, [sizes[lang] for lang in langs], counts)


def training_rows(df: DataFrame) -> DataFrame:
    """Rows the contract lets the model learn from: not held out, with a language."""
    return df.filter((id_remainder("doc_id", 4) != 2) & F.col("lang").isNotNull())


def identify(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Language of every whole text, with its probability among the learned ones.

    NULL, empty and letterless texts are ``und`` with score 0; so is everything if nothing was learned.
    Equal code lengths go to the language first in the alphabet. One row per row of ``df``.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    ddl = f"{id_column} bigint, lang_pred string, score double"

    def make():
        known = sent.value
        return lambda batch: [batch.column(id_column), *known.predict(texts(batch, text_column))]

    return map_slices(df.select(id_column, text_column), make, ddl)


def keep_identified(df: DataFrame, model: Model, least: float, text_column: str = "text") -> DataFrame:
    """Rows, with all their columns, whose text has a language with at least ``least`` probability."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        known = sent.value

        def work(batch):
            langs, scores = known.predict(texts(batch, text_column))
            return batch.filter(pa.array([lang != UNDETERMINED and s >= least for lang, s in zip(langs, scores)]))

        return work

    return map_batches(df, make, df.schema)
