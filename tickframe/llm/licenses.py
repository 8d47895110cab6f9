"""License scans: exact phrases by word hashes, and notices with a few errors.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, has one piece
without an edit (pigeonhole), so exact finds of the pieces locate every
candidate.  The ``regex`` library's bounded-error matching then verifies the
text around each candidate and reports the span and the number of edits.

Texts are compared in a plain form: A-Z lower-cased, and one space for each
run of bytes that separate words.  Spans of the fuzzy finds are in code points
of the original text.

Cases: a null text is empty; a text without words has counts of 0 and null
positions; places may overlap and repeat, all are counted; whole texts of any
length are read; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickframe.llm.blocks import LETTER_WORDS, Words, batch_of, pieces, text_bytes

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched with errors: text in plain form, label, most edits.
NOTICES = (
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("apache license version 2 0", "apache", 3),
    ("licensed under the apache license", "apache", 3),
    ("released under the mit license", "mit", 3),
    ("creative commons attribution", "cc-by", 3),
    ("licensed under cc by", "cc-by", 2),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 7),
    ("mozilla public license", "mpl", 2),
)


@dataclass(frozen=True)
class Seed:
    piece: bytes
    notice: int
    at: int                                               # where the piece starts in its notice


def seeds(notices=NOTICES) -> list[Seed]:
    out = []
    for n, (text, _, most) in enumerate(notices):
        raw, k = text.encode(), most + 1
        cuts = [len(raw) * i // k for i in range(k + 1)]
        out += [Seed(raw[a:b], n, a) for a, b in zip(cuts, cuts[1:])]
    return out


def plain(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The plain form of a run of texts, and where each of its bytes comes from.

    A NUL byte stands between two texts, so that nothing matches across them.
    """
    n = len(words.start)
    size = words.end - words.start + 1                    # the word and what stands after it
    first = np.cumsum(size) - size
    src = np.repeat(words.start - first, size) + np.arange(size.sum())
    low = LETTER_WORDS.astype(np.int64) - 1
    out = np.full(len(src), 0x20, np.uint8)
    gap = first + size - 1
    body = np.ones(len(src), bool)
    body[gap] = False
    out[body] = low[data[src[body]]]
    if n:
        last = np.append(words.row[1:] != words.row[:-1], True)
        out[gap[last]] = 0
    return out, src


def fuzzy_spans(data: np.ndarray, words: Words, notices, found, pats) -> list[tuple[int, int, int, int, int]]:
    """(row, notice, first byte, byte after the last, edits) of each find in a run of texts."""
    flat, src = plain(data, words)
    text = flat.tobytes()
    ends = np.flatnonzero(flat == 0)                      # ends of the texts that have words
    rows = words.row[words.first[:-1][np.diff(words.first) > 0]] if len(ends) else np.zeros(0, np.int64)
    windows: dict[tuple[int, int], list[list[int]]] = {}
    for s in found:
        pad = notices[s.notice][2]
        size = len(notices[s.notice][0])
        at = text.find(s.piece)
        while at >= 0:
            doc = int(np.searchsorted(ends, at))
            lo = max(0 if doc == 0 else int(ends[doc - 1]) + 1, at - s.at - pad)
            hi = min(int(ends[doc]), at - s.at + size + pad)
            windows.setdefault((doc, s.notice), []).append([lo, hi])
            at = text.find(s.piece, at + 1)
    out = []
    for (doc, notice), spans in windows.items():
        spans.sort()
        merged = [spans[0]]
        for lo, hi in spans[1:]:
            if lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        for lo, hi in merged:
            for m in pats[notice].finditer(text, lo, hi):
                if m.end() > m.start():
                    out.append((int(rows[doc]), notice, int(src[m.start()]), int(src[m.end() - 1]) + 1, sum(m.fuzzy_counts)))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
                  notices=NOTICES) -> DataFrame:
    """Per row: word and phrase counts, labels, and ``finds``: label, start, end (code points) and edits of each notice."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("finds", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])))])
    phrase_list = list(phrases.items())
    seed_list = seeds(notices)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        pats = [regex.compile(rb"(?b)(?:%s){e<=%d}" % (regex.escape(t.encode(), special_only=True), k)) for t, _, k in notices]
        off, raw = text_bytes(pa.array([p for p, _ in phrase_list]))
        w = Words(off, raw, LETTER_WORDS)
        wanted = [w.hash[w.first[r]:w.first[r + 1]] for r in range(len(phrase_list))]
        for b in batches:
            for lo, hi, off, data in pieces(b.column(1)):
                w = Words(off, data, LETTER_WORDS)
                n = hi - lo
                label_sets: list[set] = [set() for _ in range(n)]
                every = []
                for (phrase, label), want in zip(phrase_list, wanted):
                    m = len(w.hash) - len(want) + 1
                    if m <= 0:
                        continue
                    hit = w.row[:m] == w.row[len(want) - 1:]
                    for j, h in enumerate(want):
                        hit &= w.hash[j:m + j] == h
                    at = np.flatnonzero(hit)
                    every.append(at)
                    for r in np.unique(w.row[at]):
                        label_sets[r].add(label)
                at = np.sort(np.concatenate(every)) if every else np.zeros(0, np.int64)
                place, row = at - w.first[w.row[at]], w.row[at]
                n_base = np.bincount(row, minlength=n)
                first, last = np.full(n, -1), np.full(n, -1)
                last[row] = place                          # places rise within a row
                first[row[::-1]] = place[::-1]
                base = [",".join(sorted(s)) for s in label_sets]
                score = (n_base > 0).astype(float)
                finds: list[list] = [[] for _ in range(n)]
                for r, notice, s, e, edits in fuzzy_spans(data, w, notices, seed_list, pats):
                    text, label, _ = notices[notice]
                    label_sets[r].add(label)
                    score[r] = max(score[r], 1 - edits / len(text))
                    points = [int(((data[off[r]:x] & 0xC0) != 0x80).sum()) for x in (s, e)]
                    finds[r].append({"label": label, "start": points[0], "end": points[1], "edits": edits})
                yield batch_of(schema, [
                    b.column(0).slice(lo, n), np.diff(w.first), n_base,
                    pa.array(first, mask=first < 0), pa.array(last, mask=last < 0), base,
                    [",".join(sorted(s)) for s in label_sets], score,
                    [sorted(f, key=lambda x: (x["start"], x["end"], x["label"])) for f in finds]])

    return docs.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{text_col}` as string) as text").mapInArrow(
        scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, finds array<struct<label: string, start: long, end: long, edits: long>>")
