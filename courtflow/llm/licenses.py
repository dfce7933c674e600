"""Search for short licence notices, exact and with a few edits.

A notice may differ from its wording by up to k edits. Cut into k + 1 pieces, at least one piece
then stands unchanged in the text (pigeonhole). So plain search for the pieces, over each whole
text, finds the places worth a look; there the regex library matches the notice with at most k
errors and tells the edits and the span. A notice of no edits is its own only piece.

Texts are compared as words: A-Z in lower case, runs of other ASCII than letters and digits as one
space. A null or empty text has no words and no labels. Each row stands alone, so repeated rows
give repeated results; only doc_id and text are read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from courtflow.llm.common import map_slices, table
from courtflow.llm.words import ALNUM, LOWER, raw


@dataclass(frozen=True)
class Notice:
    label: str
    wording: str
    edits: int
    base: bool = False  # its unchanged places are counted


NOTICES = (
    Notice("cc-by", "cc by", 0, True),
    Notice("gpl", "general public license", 2, True),
    Notice("reserved", "all rights reserved", 2, True),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("cc-by-nc", "cc by nc", 0),
    Notice("cc-by-sa", "cc by sa", 0),
    Notice("cc-by-nd", "cc by nd", 0),
    Notice("cc0", "creative commons zero", 2),
    Notice("apache", "licensed under the apache license", 3),
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("no-warranty", "the software is provided as is without warranty of any kind", 5),
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, "
    "matches array<struct<label:string, first_word:long, n_words:long, edits:long, score:double>>"
)


def seeds(notice: Notice) -> list[tuple[bytes, int]]:
    """k + 1 pieces of even length and their places in the wording."""
    text, parts = f" {notice.wording} ".encode(), notice.edits + 1
    cuts = [len(text) * i // parts for i in range(parts + 1)]
    return [(text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def _compiled(notices: tuple[Notice, ...]) -> list[tuple[Notice, list[tuple[bytes, int]], regex.Pattern]]:
    return [
        (n, seeds(n), regex.compile(rf"(?b) (?:{regex.escape(n.wording, literal_spaces=True)}){{e<={n.edits}}} ".encode()))
        for n in notices
    ]


def find(words: bytes, notices: tuple[Notice, ...] = NOTICES) -> list[tuple[Notice, int, int, int]]:
    """(notice, start, end, edits) in words, which are single-spaced with a space at both ends.

    Start and end are those of the words matched, without the spaces around them.
    """
    found = []
    for notice, pieces, pattern in _compiled(notices):
        places = set()
        for piece, ahead in pieces:
            at = words.find(piece)
            while at >= 0:
                places.add(at - ahead)
                at = words.find(piece, at + 1)
        done = -1
        for place in sorted(places):
            if not notice.edits:
                found.append((notice, place + 1, place + 1 + len(notice.wording), 0))
                continue
            # all that a match holding this piece can cover, with the spaces around it
            begin = max(0, place - notice.edits)
            if begin + 1 < done:
                begin = done - 1
            match = pattern.search(words, begin, place + len(notice.wording) + 2 + 2 * notice.edits)
            if match:
                found.append((notice, match.start() + 1, match.end() - 1, sum(match.fuzzy_counts)))
                done = match.end()
    return found


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Labels of each document, and its matches with their places in words and edits."""
    schema = pa.schema([
        *((n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("matches", pa.list_(pa.struct([
            ("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
            ("edits", pa.int64()), ("score", pa.float64()),
        ]))),
    ])
    spaced = bytes(LOWER[b] if ALNUM[LOWER[b]] else 32 for b in range(256))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = raw(batch.column("text"))
        data = data.tobytes().translate(spaced)
        rows = []
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:], strict=False):
            split = data[a:b].split()
            words = b" " + b" ".join(split) + b" "
            matches, base, found = [], [], find(words, notices)
            # every word has one space before it, so the places of spaces number the words
            spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32) if found else None
            places = np.array([(begin, end) for _, begin, end, _ in found], np.int64).reshape(-1, 2)
            before = np.searchsorted(spaces, places).tolist() if found else []
            for (notice, _, _, edits), (first, last) in zip(found, before, strict=True):
                first, n_words = first - 1, last - first + 1
                score = 1 - edits / len(notice.wording)
                matches.append({"label": notice.label, "first_word": first, "edits": edits, "score": score, "n_words": n_words})
                if notice.base and not edits:
                    base.append((first, notice.label))
            rows.append((
                doc_id, len(split), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                ",".join(sorted({x for _, x in base})), ",".join(sorted({m["label"] for m in matches})),
                max((m["score"] for m in matches), default=0.0), matches,
            ))
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return map_slices(docs.select("doc_id", "text"), run, SCHEMA)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("matches")
