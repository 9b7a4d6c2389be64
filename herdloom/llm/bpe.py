"""Byte-pair encoding with forced boundaries, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache
from operator import itemgetter

import numpy as np
import regex
from pyspark.sql import DataFrame

from herdloom.llm.base import map_slices, texts

# How a byte-level tokenizer splits a text into words, with \p{L}, \p{N} and white space as
# L, N and S. The classes are spelled out for texts within Latin-1, where the plain engine is faster.
WORDS = r" ?[L]+| ?[N]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^SLN]+|[S]+(?![^S])|[S]+"
ANY = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}"}
LATIN = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": "0-9\xb2\xb3\xb9\xbc-\xbe", "S": "\t-\r \x85\xa0"}


def _with(classes: dict[str, str]) -> str:
    return "".join(classes.get(c, c) for c in WORDS)


SPLIT = regex.compile(_with(ANY))
SPLIT_LATIN = re.compile(_with(LATIN))


def split_words(text: str) -> list[str]:
    """Words of a text, no merge crosses from one into the next."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return SPLIT.findall(text)
    return SPLIT_LATIN.findall(text)


#: Words whose ids a task keeps at hand; beyond it the store starts anew.
KEPT_WORDS = 60_000
#: Words up to this many characters are merged side by side, longer ones each with a heap.
SHORT = 48
NO_RANK = 1 << 62


def byte_letters() -> dict[str, int]:
    """The printable letter that a vocabulary file writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    """Encoder and decoder over one byte-level vocabulary file.

    A pair of bytes that occurs inside no token of the vocabulary can never be joined by merges, so a
    cut between the two changes no id. Words are cut at all such pairs and their fragments encoded on
    their own: fragments repeat far more often than words.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ids = {as_bytes(token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Rank of each pair of ids, packed into one number, and the id of the two together by rank.
        self.ranks, self.joined = {}, []
        for rank, (left, right) in enumerate(pairs):
            left, right = as_bytes(left), as_bytes(right)
            self.ranks.setdefault(ids[left] << 32 | ids[right], rank)
            self.joined.append(ids[left + right])
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int64)
        self.joined_ids = np.array(self.joined, np.int64)
        #: By first byte times 256 plus second: 1 where some token has the two side by side.
        inside = bytearray(65_536)
        for token in ids:
            for a, b in zip(token, token[1:]):
                inside[a << 8 | b] = 1
        self.inside = bytes(inside)
        self.inside_flags = np.frombuffer(self.inside, np.uint8)
        known = {i: token for token, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.pieces = [known.get(i, b"") for i in range(max(known) + 1)]
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        self.special_words = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.words = dict(self.special_words)

    def fragments_of(self, word: bytes) -> list[bytes]:
        """The word cut between every two bytes that stand side by side in no token."""
        inside = self.inside
        cuts = [i for i, (a, b) in enumerate(zip(word, word[1:]), 1) if not inside[a << 8 | b]]
        if not cuts:
            return [word]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], NO_RANK)

    def merge_all(self, data: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and the fragment of each, for the bytes ``data`` of many fragments merged side by side.

        Each round joins in every fragment the pair of least rank, the leftmost of equals, and looks up
        only the two pairs that this changes; fragments without a pair to join drop out.
        """
        parts, owner = np.array(self.byte_ids, np.int64)[data], fragment
        ranks = np.full(len(parts), NO_RANK)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inner] = self.pair_ranks(parts[inner], parts[inner + 1])
        done_parts, done_owner = [], []
        while len(parts):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.r_[starts, len(parts)]))
            keep = least != NO_RANK
            done_parts.append(parts[~keep])
            done_owner.append(owner[~keep])
            hits = np.flatnonzero((ranks == least) & keep)
            hits = hits[np.r_[True, owner[hits][1:] != owner[hits][:-1]][: len(hits)]]
            parts[hits] = self.joined_ids[ranks[hits]]
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            parts, owner, ranks = parts[keep], owner[keep], ranks[keep]
            hits = moved[hits]
            ranks[hits] = NO_RANK
            for at in (hits[hits + 1 < len(parts)], hits[hits > 0] - 1):
                at = at[owner[at] == owner[at + 1]]
                ranks[at] = self.pair_ranks(parts[at], parts[at + 1])
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_parts)[order], owner[order]

    def merge_long(self, fragment: bytes) -> bytes:
        """The same for one fragment with a heap and linked neighbours: n log n at any length."""
        parts = [self.byte_ids[b] for b in fragment]
        n, ranks = len(parts), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = after[i]
            rank = ranks.get(parts[i] << 32 | parts[j]) if j < n else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.joined[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Put the packed ids of all ``words`` into the store."""
        for word in [w for w in words if len(w) > SHORT]:
            self.words[word] = b"".join(map(self.merge_long, self.fragments_of(word.encode())))
        words = [w for w in words if len(w) <= SHORT]
        if not words:
            return
        raw = [w.encode() for w in words]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        cut = np.r_[True, (word[1:] != word[:-1]) | (self.inside_flags[data[:-1] << 8 | data[1:]] == 0)]
        ids, fragment = self.merge_all(data, np.cumsum(cut) - 1)
        sizes = np.bincount(word[cut][fragment], minlength=len(words))
        packed, ends = ids.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        self.words.update(zip(words, [packed[a:b] for a, b in zip([0, *ends], ends)]))

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = []
        for text in texts:
            if self.special_split and any(token in text for token in self.special):
                parts = [p for p in self.special_split.split(text) if p]
                split.append([w for p in parts for w in ([p] if p in self.special else split_words(p))])
            else:
                split.append(split_words(text))
        needed = set().union(*split)
        new = needed.difference(self.words)
        if len(self.words) + len(new) > KEPT_WORDS:
            self.words = dict(self.special_words)
            new = needed.difference(self.words)
        self.learn(new)
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed([text])[0], "<u4").tolist()

    def decode(self, ids) -> str:
        """Text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        ids = list(ids)
        pieces = itemgetter(*ids)(self.pieces) if len(ids) > 1 else [self.pieces[i] for i in ids]
        return b"".join(pieces).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ForcedBoundaryBPE:
    """A model that stays in memory; tasks make their own, which ends with them."""
    return ForcedBoundaryBPE(path)


def encode_texts(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of every whole text under the vocabulary file at ``path``: ``token_ids`` and ``n_tokens``.

    ``path`` must be readable where tasks run; each task reads it once. NULL reads as empty, and an
    empty text has no ids. One row per row of ``df``.
    """
    ddl = f"{id_column} bigint, n_tokens bigint, token_ids array<bigint>"

    def make():
        model = ForcedBoundaryBPE(path)

        def work(batch):
            packed = model.encode_packed(texts(batch, text_column))
            ids = [np.frombuffer(p, "<u4").tolist() for p in packed]
            return [batch.column(id_column), [len(i) for i in ids], ids]

        return work

    return map_slices(df.select(id_column, text_column), make, ddl)


def decode_ids(df: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """Texts of rows of ids; NULL reads as no ids. The inverse of ``encode_texts``."""
    ddl = f"{id_column} bigint, text string"

    def make():
        model = ForcedBoundaryBPE(path)
        return lambda batch: [
            batch.column(id_column),
            [model.decode(ids or []) for ids in batch.column(ids_column).to_pylist()],
        ]

    return map_slices(df.select(id_column, ids_column), make, ddl)


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Digests of the ids of every whole text and of the text decoded from them.

    The ids stay packed and no list of them leaves the task. NULL reads as empty; one row per row.
    """
    ddl = f"{id_column} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def make():
        model = ForcedBoundaryBPE(path)

        def work(batch):
            packed = model.encode_packed(texts(batch, text_column))
            decoded = (model.decode(np.frombuffer(p, "<u4").tolist()) for p in packed)
            return [
                batch.column(id_column),
                [len(p) // 4 for p in packed],
                [hashlib.sha256(p).hexdigest() for p in packed],
                [hashlib.sha256(d.encode()).hexdigest() for d in decoded],
            ]

        return work

    return map_slices(df.select(id_column, text_column), make, ddl)
