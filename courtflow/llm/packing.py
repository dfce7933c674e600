"""Packing of token sequences by the sum-of-squares rule.

Documents come one by one. A document of at least one window fills whole windows; what is left
goes to the fill level at which the sum of squared counts of partially filled windows grows least,
or to a new window where that grows it less. The counts stand in one array, entry h for windows
filled to h tokens. Each partition of the input is packed by itself, in one pass, with nothing to
shuffle: one array and the tokens of the open windows are held. When a partition ends, what lies in
open windows is cut anew into full windows, and the rest into powers of two, so that no sequence
needs padding.

A null or empty text is the single id 0. Repeated rows are packed once per row. Only doc_id and
text are read, so other columns may have any name. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from courtflow.llm.common import BATCH_BYTES, BATCH_ROWS, gathered, table
from courtflow.llm.words import SLICE_BYTES, hash_ranges, raw, slices

WINDOW = 1024
VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
CACHED_UNITS = 1_000_000
#: Where a text holds one of these it is not cut into units: white space and controls by which
#: units could be joined, and the special token's text.
_WHOLE = re.compile(
    r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]|" + re.escape(SPECIAL)
)
#: For each byte: whether a text that _WHOLE finds must have one of those; first bytes, and the special token's rarest.
_MAY_BE_WHOLE = bytes(b in b"\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3\xef|" for b in range(256))
#: White space 0, digits and letters of ASCII 1, its punctuation 2, all else 3; and between which of them a unit ends.
_KINDS = bytes(0 if b == 32 or 9 <= b <= 13 else 3 if not 32 < b < 127 else 1 if chr(b).isalnum() else 2 for b in range(256))
_CUT = np.array([right == 0 < left or (left, right) == (1, 2) for left in range(4) for right in range(4)])
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


class UnitTokenizer:
    """Ids of whole texts, put together from the ids of units that are kept.

    A unit is a run of white space and the word after it, cut once more where punctuation follows a
    letter or digit (all of ASCII). The vocabulary's pattern never joins what stands on the two sides
    of a unit's start, so a text's ids are its units' ids in a row. Units are looked up by hash in
    sorted arrays; only new ones go through the tokenizer. The kept units are bounded: when the
    arrays are full they start anew.
    """

    def __init__(self, path: str, most: int = CACHED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        """Keep units whose keys are in ascending order, and new."""
        ids = self.ids(units)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        at = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))])
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, at)
        self.count = np.insert(self.count, place, count)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        data, offsets = raw(texts)
        held = data.tobytes()
        kind = np.frombuffer(held.translate(_KINDS), np.uint8)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = len(data) > 0
        edge[1:-1] |= _CUT[kind[:-1] * 4 + kind[1:]]
        edges = np.flatnonzero(edge)
        begin, end = edges[:-1], edges[1:]
        text = np.searchsorted(offsets, begin, "right") - 1
        keys, where, back = np.unique(hash_ranges(data, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._forget()
        found = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = found < len(self.keys)
        new[inside] = self.keys[found[inside]] != keys[inside]
        if new.any():
            pick = where[new]
            self._learn(keys[new], [held[b:e].decode() for b, e in zip(begin[pick].tolist(), end[pick].tolist(), strict=True)])
            found = np.searchsorted(self.keys, keys)
        count, at = self.count[found][back], self.at[found][back]
        ends = np.cumsum(count)
        flat = self.flat[np.arange(count.sum()) + np.repeat(at - (ends - count), count)]
        cuts = np.cumsum(np.bincount(text, count, len(texts)).astype(np.int64))
        out = np.split(flat, cuts[:-1])
        # only texts with a byte that one of these has are searched for them
        may = np.flatnonzero(np.frombuffer(held.translate(_MAY_BE_WHOLE), bool))
        may = np.unique(np.searchsorted(offsets, may, "right") - 1).tolist()
        odd = [(k, x) for k, x in zip(may, texts.take(pa.array(may, pa.int64())).to_pylist(), strict=True) if _WHOLE.search(x)]
        for (k, _), ids in zip(odd, self.ids([x for _, x in odd]), strict=True):
            out[k] = np.array(ids, np.uint32)
        return out


class LevelPacker:
    """Windows of one partition; finished pieces leave as (document, start, ids, sequence, offset)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window, np.int64)  # open windows filled to h, for h from 1
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.sequence = 0

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for document, start, ids in pieces:
            yield document, start, ids, self.sequence, at
            at += len(ids)
        self.sequence += 1

    def level_for(self, size: int) -> int:
        """The level that a piece of so many tokens joins, the fullest of equals; 0 is a new window."""
        counts, full = self.counts, self.window - size
        levels = np.flatnonzero(counts[: full + 1])
        growth = 1 - 2 * counts[levels]
        inner = levels < full
        growth[inner] += 2 * counts[levels[inner] + size] + 1
        fresh = 2 * counts[size] + 1
        if not len(levels) or fresh < growth.min():
            return 0
        return int(levels[np.flatnonzero(growth == growth.min())[-1]])

    def add(self, document: int, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            yield from self._close([(document, start, ids[start : start + self.window])])
        size = len(ids) - whole
        if not size:
            return
        level, pieces = self.level_for(size), []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        pieces.append((document, whole, ids[whole:].copy()))
        if level + size == self.window:
            yield from self._close(pieces)
        else:
            self.open[level + size].append(pieces)
            self.counts[level + size] += 1

    def finish(self) -> Iterator[tuple]:
        """Cut what lies in open windows into full windows and powers of two."""
        rest = [p for level in self.open for pieces in level for p in pieces]
        left = sum(len(p[2]) for p in rest)
        rest.reverse()
        while left:
            room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                document, start, ids = rest.pop()
                pieces.append((document, start, ids[:room]))
                if len(ids) > room:
                    rest.append((document, start + room, ids[room:]))
                room -= len(pieces[-1][2])
            yield from self._close(pieces)
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0


def packed(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: where each starts in its document and lies in its sequence.

    with_ids adds the ids themselves. Sequence ids are unique; their high bits are the partition.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    types = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    if with_ids:
        types = types.append(pa.field("ids", pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = _tokenizer(path), LevelPacker(window)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            rows.clear()
            return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, types, strict=True)], schema=types)

        def take(pieces: Iterator[tuple]) -> None:
            for (document, tokens), start, ids, sequence, offset in pieces:
                crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
                row = (document, start, len(ids), crc, tokens, base + sequence, offset)
                rows.append(row + ((ids.tolist(),) if with_ids else ()))

        for batch in gathered(batches, "text", SLICE_BYTES):
            for piece in slices(batch):
                for document, ids in zip(piece.column("doc_id").to_pylist(), tokenizer.encode(piece.column("text")), strict=True):
                    take(packer.add((document, len(ids) + 1), np.append(ids, np.uint32(0))))
                yield flushed()
        take(packer.finish())
        yield flushed()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))


_TOKENIZERS: dict[str, UnitTokenizer] = {}


def _tokenizer(path: str) -> UnitTokenizer:
    """One per worker process, so that its units last over tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = UnitTokenizer(path)
    return _TOKENIZERS[path]


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
