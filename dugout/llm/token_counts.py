"""Token counts of sections by offset-mapped attribution.

A document is encoded once, whole. Byte-level tokens join to exactly the text's bytes, so their lengths
give every token's byte and character span. Sections (lines, or any spans that cover the text) are
interval-joined to the token spans, and a token that crosses a boundary goes by an explicit rule:

    start   to the section that holds its first character
    most    to the section that holds most of its characters, the earlier of equals
    share   to each section in proportion to its characters (fractions)

So under every rule the sections' counts sum to the document's tokens. Both sides of the interval join
come from one document, so it is done where the document is, on sorted spans, without a shuffle; a task holds a
bounded run of texts.

Cases: null or empty texts are one empty section of 0 tokens; a section may be empty (an empty line still has its
line break, but the last may have nothing); repeated rows and null doc_ids are counted like others; an empty
table gives an empty result; extra columns are ignored; very long texts are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, text_or_empty

RULES = ("start", "most", "share")
# Fixed value: the pattern that splits text before the merges of byte-level rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, tuple] = {}


def vocabulary(path: str) -> tuple:
    """(encoding, bytes of every id) of a byte-level rank file, loaded once per worker process."""
    if path not in _LOADED:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            sizes[i] = len(token)
        _LOADED[path] = tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes
    return _LOADED[path]


def line_starts(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the lines of a text start; a line keeps its line break."""
    return np.concatenate(([0], np.flatnonzero(data[:-1] == 10) + 1)) if len(data) else np.zeros(1, np.int64)


def attribute(first: np.ndarray, stop: np.ndarray, sections: np.ndarray, end: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Interval join of sorted token spans [first, stop) and section starts (characters) up to ``end``.

    Returns (tokens of each section under the rule, tokens that cross into or out of each section)."""
    n = len(sections)
    a = np.searchsorted(sections, first, "right") - 1
    b = np.searchsorted(sections, stop - 1, "right") - 1
    tokens = np.bincount(a[a == b], minlength=n).astype(float)
    crossing = np.zeros(n, np.int64)
    over = np.flatnonzero(a != b)
    if len(over):
        width = b[over] - a[over] + 1
        section = np.repeat(a[over], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        token = np.repeat(over, width)
        ends = np.append(sections[1:], end)
        chars = np.minimum(stop[token], ends[section]) - np.maximum(first[token], sections[section])
        np.add.at(crossing, section, 1)
        if rule == "share":
            np.add.at(tokens, section, chars / (stop[token] - first[token]))
        else:
            heads = np.cumsum(width) - width
            if rule == "start":
                pick = heads
            else:
                order = np.lexsort((section, -chars, token))       # most characters first, the earlier of equals
                pick = order[heads]
            np.add.at(tokens, section[pick], 1)
    return tokens, crossing


def count_text(text: str, path: str, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(section starts, section ends in characters, tokens, crossing tokens) of a text's lines."""
    encoding, sizes = vocabulary(path)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    starts = line_starts(data)
    if not len(data):
        return starts, starts.copy(), np.zeros(1), np.zeros(1, np.int64)
    ids = encoding.encode_to_numpy(text, disallowed_special=())
    stop = np.cumsum(sizes[ids])
    first = stop - sizes[ids]
    lead = (data & 0xC0) != 0x80
    char = np.cumsum(lead) - 1                                       # the character that each byte is part of
    sections = char[np.minimum(starts, len(data) - 1)]
    tokens, crossing = attribute(char[first], char[stop - 1] + 1, sections, len(text), rule)
    return sections, np.append(sections[1:], len(text)), tokens, crossing


def _counter(path: str, rule: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held, rows = [], [], 0
            for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                held.append(count_text(text.as_py(), path, rule))
                ids.append(doc_id.as_py())
                rows += len(held[-1][0])
                if rows >= 20_000:
                    yield _rows(ids, held)
                    ids, held, rows = [], [], 0
            if held:
                yield _rows(ids, held)
    return count


def _rows(ids: list, held: list[tuple]) -> pa.RecordBatch:
    n = np.array([len(h[0]) for h in held])
    total = np.array([h[2].sum() for h in held])
    section = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(ids)), n))), pa.array(section),
         *[pa.array(np.concatenate([h[i] for h in held]).astype(kind)) for i, kind in ((0, np.int64), (1, np.int64), (2, float), (3, np.int64))],
         pa.array(np.rint(np.repeat(total, n)).astype(np.int64))],
        ["doc_id", "section", "first_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"])


def section_tokens(docs: DataFrame, rank_file: str, rule: str = "most") -> DataFrame:
    """A row per line of every document: its characters [first_char, end_char), its tokens under the rule, the
    tokens that cross its bounds, and the document's tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship_package(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(_counter(rank_file, rule), "doc_id long, section long, first_char long, end_char long, "
                                                   "n_tokens double, n_crossing long, doc_tokens long"))
