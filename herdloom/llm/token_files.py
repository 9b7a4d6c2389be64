"""Token ids of whole texts as files: ids ranked by frequency, in byte-aligned variable-length coding.

The file format. A folder has two Parquet tables. ``ranks`` lists the ids by frequency, the most frequent
first; ``blocks`` holds the ids of all documents in order of their id, in blocks of whole documents: ids of
the documents, the number of token ids of each, and two byte strings. An id is written as its rank in 1 to
4 bytes, lowest first, in ``data``; ``control`` has two bits per id, its number of bytes less one, four
ids to a byte from the lowest bits up. A block is decoded four ids at a time: a control byte names the
places of their bytes in a table. Parquet carries the blocks, so Spark commits them and splits the reading.
"""

from __future__ import annotations

import itertools
import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from herdloom.llm.base import SLICE_ROWS, arrow_schema, map_slices, prepare, release, texts
from herdloom.llm.bpe import ANY, byte_letters, split_words
from herdloom.sources.tables import shared_path

#: Id written after each document.
END = 0
#: Ids of a block, but for a document that has more.
BLOCK_IDS = 1 << 19
#: Words whose ids a Python worker keeps at hand, some 160 MB; beyond it, and between tasks, the first half stays,
#: which the most frequent are in.
KEPT_WORDS = 800_000
#: Characters of the texts that are cut into words side by side; a text with more is cut on its own.
SIDE_BY_SIDE = 1 << 20
#: Groups of four ids decoded at a time.
GROUPS = 1 << 15

# Kinds of characters that words are made of.
LETTER, DIGIT, OTHER, SPACE = range(4)

#: By control byte: bytes of its four ids, and for each of their 16 places the byte to take, -1 for none.
WIDTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3) + 1
TOTALS = WIDTHS.sum(1)
_FIRST = np.cumsum(WIDTHS, 1) - WIDTHS
PLACES = np.where(np.arange(4) < WIDTHS[:, :, None], _FIRST[:, :, None] + np.arange(4), -1).reshape(256, 16)

BLOCKS = "part int, block int, n_docs bigint, n_tokens bigint, doc_ids array<bigint>, sizes array<bigint>"


def code(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit numbers."""
    values = values.astype("<u4")
    extra = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[: len(values)] = extra
    control = (quads.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(1, dtype=np.uint8)
    most = int(extra.max(initial=0)) + 1
    data = values.view(np.uint8).reshape(-1, 4)[:, :most][np.arange(most) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``code``."""
    control = np.frombuffer(control, np.uint8)
    # The last group may be short of up to three ids, whose places read one byte each.
    data = np.append(np.frombuffer(data, np.uint8), np.zeros(4, np.uint8))
    data[-1] = 0
    ends = np.cumsum(TOTALS[control])
    out = np.empty((len(control), 16), np.uint8)
    for low in range(0, len(control), GROUPS):
        part = control[low : low + GROUPS]
        place = PLACES[part]
        at = (ends[low : low + GROUPS] - TOTALS[part])[:, None] + place
        out[low : low + GROUPS] = data[np.where(place < 0, len(data) - 1, at)]
    return out.reshape(-1).view("<u4")[:n]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of each code point."""
    out, every = np.full(0x110000, OTHER, np.uint8), "".join(map(chr, range(0x110000)))
    for kind, name in ((LETTER, "L"), (DIGIT, "N"), (SPACE, "S")):
        for found in regex.finditer(f"[{ANY[name]}]+", every):
            out[found.start() : found.end()] = kind
    return out


def word_starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of ``split_words`` start, in code points of texts that begin at ``begins``.

    A word is a run of one kind of character. A blank goes with the run behind it, and of more white space the
    last character stands apart from the rest, but for the end of a text. A mark that starts a word takes the
    letters of a contraction with it.
    """
    kind = kinds()[codes]
    head = np.zeros(len(codes) + 2, bool)
    head[begins] = head[len(codes) :] = True
    starts = np.append(True, kind[1:] != kind[:-1]) | head[:-2]
    behind = np.flatnonzero(starts & ~head[:-2] & (kind != SPACE))
    behind = behind[kind[behind - 1] == SPACE]
    starts[behind - 1] = True
    starts[behind] = codes[behind - 1] != ord(" ")
    marks = np.flatnonzero((codes == ord("'")) & starts)
    marks = marks[~head[marks + 1]]
    padded = np.append(codes, [0, 0])
    one, two = padded[marks + 1], np.where(head[marks + 2], 0, padded[marks + 2])
    size = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    for a, b in ("re", "ve", "ll"):
        size[(one == ord(a)) & (two == ord(b))] = 2
    marks, size = marks[size > 0], size[size > 0]
    starts[marks + 1] = False
    ends = marks + 1 + size
    starts[ends[ends < len(codes)]] = True
    return starts


class Words(dict):
    """Packed ids of words in UTF-8, which the library's model makes when a word is first asked for."""

    def __init__(self, library, kind: np.dtype, words=()):
        super().__init__(words)
        self.library, self.code, self.tokenize = library, "H" if kind.itemsize == 2 else "I", library.model.tokenize
        self.special = {t.content.encode(): i for i, t in library.get_added_tokens_decoder().items()}
        #: How the vocabulary writes a byte.
        self.letters = str.maketrans({byte: letter for letter, byte in byte_letters().items()})

    def __missing__(self, word: bytes) -> bytes:
        if word in self.special:
            ids = [self.special[word]]
        else:
            ids = [t.id for t in self.tokenize(word.decode("latin-1").translate(self.letters))]
        packed = self[word] = array(self.code, ids).tobytes()
        return packed


class Encoder:
    """The tokenizers library over words: each different word is encoded once as long as it is at hand.

    Under a plain byte-level vocabulary a text falls into words, which the library's model turns into ids on
    their own; under any other the library gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        odd = any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized"))
        self.by_word = (
            spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not spec.get("normalizer") and not odd
        )
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = set(names)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.words = Words(self.library, self.kind)

    def words_of(self, text: str) -> list[str]:
        if self.split and any(token in text for token in self.special):
            parts = [p for p in self.split.split(text) if p]
            return [w for p in parts for w in ([p] if p in self.special else split_words(p))]
        return split_words(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as numbers of ``kind``."""
        if not self.by_word:
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, self.kind).tobytes() for e in found]
        out, group, size = [], [], 0
        for text in texts:
            alone = len(text) > SIDE_BY_SIDE or any(token in text for token in self.special)
            if alone or size + len(text) > SIDE_BY_SIDE:
                out += self.side_by_side(group)
                group, size = [], 0
            if alone:
                self.make_room()
                out.append(b"".join(self.words[word.encode()] for word in self.words_of(text)))
            else:
                group.append(text)
                size += len(text)
        return out + self.side_by_side(group)

    def side_by_side(self, texts: list[str]) -> list[bytes]:
        """The same for texts without special tokens, each different word of which is looked up once."""
        self.make_room()
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        raw, ends = joined.encode(), np.cumsum([len(text) for text in texts])
        begins = np.append(0, ends[:-1])
        if len(raw) == len(joined):
            places = starts = np.flatnonzero(word_starts(np.frombuffer(raw, np.uint8), begins))
        else:
            codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            starts = np.flatnonzero(word_starts(codes, begins))
            wide = (codes >= 0x80).astype(np.uint8) + (codes >= 0x800) + (codes >= 0x10000)
            places = starts + (np.cumsum(wide, dtype=np.int64) - wide)[starts]
        offsets = np.append(places, len(raw)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
        found = pa.Array.from_buffers(pa.binary(), len(places), buffers).dictionary_encode()
        packed = list(map(self.words.__getitem__, found.dictionary.to_numpy(zero_copy_only=False).tolist()))
        ids = np.frombuffer(b"".join(packed), self.kind)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.kind.itemsize
        word = found.indices.to_numpy()
        many = sizes[word]
        stops = np.cumsum(many)
        whole = ids[np.repeat((np.cumsum(sizes) - sizes)[word] - (stops - many), many) + np.arange(stops[-1])].tobytes()
        cuts = np.append(0, stops)[np.searchsorted(starts, np.append(0, ends))] * self.kind.itemsize
        return [whole[a:b] for a, b in itertools.pairwise(cuts.tolist())]

    def make_room(self) -> None:
        if len(self.words) > KEPT_WORDS:
            self.forget(KEPT_WORDS // 2)

    def forget(self, most: int) -> None:
        """Keep the ids of no more than the first ``most`` words."""
        if len(self.words) > most:
            self.words = Words(self.library, self.kind, list(itertools.islice(self.words.items(), most)))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """The encoder of a Python worker: the next task on it finds the vocabulary loaded and its first words known."""
    return Encoder(path)


def encoded_blocks(df: DataFrame, path: str, id_column: str, text_column: str, end: int | None) -> DataFrame:
    """Blocks of documents in order of their ids, with their token ids packed in ``ids``.

    Rows are put in order by id, NULL first, and then by a hash of their texts. Equal rows are dealt by where they were
    read, so that no row repeated without end fills a task.
    """
    prepare(df.sparkSession)
    ddl = BLOCKS + ", width int, ids binary"
    schema = arrow_schema(ddl)
    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    rows = rows.withColumns({"text_key": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    order, most = ("doc_id", "text_key", "salt"), BLOCK_IDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = worker_encoder(path), TaskContext.get().partitionId(), 0
        last = b"" if end is None else np.array([end], encoder.kind).tobytes()
        docs, sizes, ids, held, width = [], [], [], 0, encoder.kind.itemsize

        def block():
            values = (part, number, len(docs), held // width, docs, sizes, width, b"".join(ids))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                for doc, packed in zip(piece.column("doc_id").to_pylist(), encoder.encode(texts(piece))):
                    docs.append(doc)
                    ids += [packed, last]
                    sizes.append((len(packed) + len(last)) // width)
                    held += len(packed) + len(last)
                    if held >= most * width:
                        yield block()
                        docs, sizes, ids, held, number = [], [], [], 0, number + 1
        if docs:
            yield block()
        encoder.forget(KEPT_WORDS // 2)
        del encoder, docs, sizes, ids
        release()

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, ddl)


def frequencies(blocks: DataFrame) -> DataFrame:
    """(id, n): occurrences of every id; a task sends each id once."""

    def run(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for width, packed in zip(batch.column("width").to_pylist(), batch.column("ids")):
                found = np.bincount(np.frombuffer(packed.as_buffer(), f"<u{width}"))
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return blocks.select("width", "ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def coded(blocks: DataFrame, ranked: np.ndarray) -> DataFrame:
    """Blocks with their ids as ranks in ``control`` and ``data``."""
    prepare(blocks.sparkSession)
    ddl = BLOCKS + ", control binary, data binary"
    schema = arrow_schema(ddl)
    sent = blocks.sparkSession.sparkContext.broadcast(ranked)

    def run(batches):
        rank = np.zeros(int(sent.value.max(initial=0)) + 1, np.uint32)
        rank[sent.value] = np.arange(len(sent.value))
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), f"<u{row.column('width')[0].as_py()}")
                made = [pa.array([value], pa.binary()) for value in code(rank[ids])]
                yield pa.RecordBatch.from_arrays([*row.columns[:6], *made], schema=schema)

    return blocks.mapInArrow(run, ddl)


def with_starts(blocks: DataFrame) -> DataFrame:
    """``start``: ids of all blocks before; added up per part and then over the parts, of which there are few."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.sum("n_tokens").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    placed = blocks.select("part", "block", F.coalesce(own, F.lit(0)).alias("own"), "n_tokens")
    return placed.join(parts, "part").select("part", "block", (F.col("before") + F.col("own")).alias("start"))


def write_ids(
    df: DataFrame, path: str, out: str, id_column: str = "doc_id", text_column: str = "text", end: int | None = END
) -> str:
    """Write the token ids of every whole text under the vocabulary file at ``path`` to the folder ``out``.

    Documents come in ascending order of their ids, NULL first, rows of one id by a hash of their texts;
    repeated rows all stay. A NULL text is empty. ``end`` is written after each document, nothing if None. Every
    text is encoded once; packed ids wait in the shared folder until all are counted.
    """
    spark = df.sparkSession
    held = shared_path(spark, "tokens-encoded")
    encoded = encoded_blocks(df, path, id_column, text_column, end)
    encoded.write.option("compression", "zstd").parquet(held)
    blocks = spark.read.schema(encoded.schema).parquet(held)
    counted = frequencies(blocks).orderBy(F.desc("n"), "id")
    ranked = np.array([row["id"] for row in counted.collect()], np.int64)
    spark.createDataFrame(list(enumerate(ranked.tolist())), "place bigint, id bigint").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{out}/ranks")
    coded(blocks, ranked).write.mode("overwrite").option("compression", "none").parquet(f"{out}/blocks")
    return out


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files of ``write_ids``.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit numbers.
    """
    ranked = np.array([r["id"] for r in spark.read.parquet(f"{out}/ranks").orderBy("place").collect()], "<u4")
    sent = spark.sparkContext.broadcast(ranked)
    blocks = spark.read.schema(BLOCKS + ", control binary, data binary").parquet(f"{out}/blocks")
    placed = blocks.join(with_starts(blocks), ["part", "block"])

    def work(batch):
        columns = [[], [], [], []]
        for docs, sizes, start, control, data, n in zip(*(batch.column(c).to_pylist() for c in (
            "doc_ids", "sizes", "start", "control", "data", "n_tokens"))):
            ids = sent.value[decode(control, data, n)].tobytes()
            ends = np.cumsum(sizes)
            columns[0] += docs
            columns[1] += (start + ends - sizes).tolist()
            columns[2] += sizes
            columns[3] += [ids[4 * (b - a) : 4 * b] for a, b in zip(sizes, ends.tolist())]
        return columns

    rows = placed.select("doc_ids", "sizes", "start", "control", "data", "n_tokens")
    return map_slices(rows, lambda: work, "doc_id bigint, start bigint, n_tokens bigint, ids binary", slice_rows=1)
