"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged across, so every such
pair is a certain cut. Each pre-token is cut at those pairs, the fragments are encoded on
their own and the ids concatenated: the result is that of merging the whole pre-token.
Fragments and pre-tokens repeat, so both are remembered, in tables of bounded size.

The tokenizer file is read on the driver and sent to the tasks once (its size is that of the
file, a few MB). There is no shuffle: a row's result depends on the row alone, and a lost
task is simply run again.

Defined results: a null or empty text has no ids and decodes to the empty text; texts of any
length are encoded whole, a long pre-token by a heap in n log n; repeated rows have equal
results; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import heapq
import json
from array import array

import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, types as T

from sessionloom.llm.common import free_names, map_text, tables

# Fixed value: the pattern that splits text into pre-tokens before byte-level merges.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens and fragments remembered before their memory starts anew, and the longest key worth it.
REMEMBERED, FRAGMENTS, LONGEST_KEY = 200_000, 50_000, 48
#: From this many bytes on, a fragment is merged with a heap.
HEAP_FROM = 48
#: Above every rank: the pair is not merged.
NEVER = 1 << 30


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next above 255."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in printable)
    stand_in = {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(stand_in.get(b, b)) for b in range(256)]


class Memory(dict):
    """Results by key; forgets everything when full, so that its size is bounded."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= LONGEST_KEY:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """A byte-level BPE tokenizer read from the text of a ``tokenizers`` JSON file."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.token_bytes[i] = token.encode()
        self.single = [vocab[c] for c in byte_characters()]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merged = [vocab[left + right] for left, right in merges]
        self.rank_of = {(vocab[left], vocab[right]): rank for rank, (left, right) in enumerate(merges)}.get
        self.inside = bytearray(1 << 16)
        for i in vocab.values():
            t = self.token_bytes[i]
            for a, b in zip(t, t[1:]):
                self.inside[a << 8 | b] = 1
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.by_fragment = Memory(self._merge, FRAGMENTS)
        self.by_pre_token = Memory(self._pre_token, REMEMBERED)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(map(text.__contains__, self.added)):
            return b"".join(map(self.by_pre_token.__getitem__, self.pre_tokens(text)))
        out = []
        for piece in self.added_split.split(text):
            if piece in self.added:
                out.append(_packed([self.added[piece]]))
            else:
                out.extend(map(self.by_pre_token.__getitem__, self.pre_tokens(piece)))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.token_bytes.__getitem__, _unpacked(packed))).decode("utf-8", "replace")

    def fragments(self, data: bytes) -> list[bytes]:
        """``data`` cut between all byte pairs that no token holds."""
        inside, start, out = self.inside, 0, []
        for i in range(1, len(data)):
            if not inside[data[i - 1] << 8 | data[i]]:
                out.append(data[start:i])
                start = i
        out.append(data[start:])
        return out

    def _pre_token(self, piece: str) -> bytes:
        return b"".join([self.by_fragment[f] for f in self.fragments(piece.encode())])

    def _merge(self, fragment: bytes) -> bytes:
        ids = [self.single[b] for b in fragment]
        return _packed(self._merge_short(ids) if len(ids) < HEAP_FROM else self._merge_long(ids))

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The leftmost pair of the lowest rank is merged until none is left."""
        rank_of, merged = self.rank_of, self.merged
        ranks = [rank_of(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            ids[i : i + 2] = [merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same order of merges from a heap over linked positions."""
        n, rank_of, merged = len(ids), self.rank_of, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := rank_of((ids[i], ids[j]), NEVER)) < NEVER:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = merged[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def _unpacked(packed: bytes) -> array:
    ids = array("I", packed)
    if ids.itemsize != 4:
        raise TypeError("unsigned int has no 32 bits here")
    return ids


def tokenizer_file(df: DataFrame, path: str) -> Broadcast:
    """The file's text on its way to every executor."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None,
           keep: bool = True) -> DataFrame:
    """Add ``ids`` (binary: little-endian unsigned 32-bit integers) of every text.

    With ``decoded``, the ids are decoded again in the same pass and that text is added too.
    Without ``keep`` the texts themselves do not come back from Python.
    """
    if free_names(df, ids, decoded or ids + "_decoded") != [ids, decoded or ids + "_decoded"]:
        raise ValueError(f"{ids} or {decoded} is a column already")
    sent = tokenizer_file(df, path)
    fields = [T.StructField(ids, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def make():
        bpe = tables(ByteBpe, sent.value)

        def work(texts):
            made = [bpe.encode(t) for t in texts]
            return [made, [bpe.decode(x) for x in made]] if decoded else [made]

        return work

    return map_text(df, fields, make, text, keep=keep)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of every row's ``ids``; null ids decode to the empty text."""
    sent = tokenizer_file(df, path)

    def make():
        bpe = tables(ByteBpe, sent.value)
        return lambda packed: [[bpe.decode(x or b"") for x in packed]]

    return map_text(df, [T.StructField(decoded, T.StringType())], make, ids)
