"""Token ids of a corpus with content-defined chunk reuse.

A text is cut where its content says so: a hash rolls over the last characters, and a position is a cut when the hash
hits. Texts that share passages share chunks, whatever precedes them, and a chunk is encoded once. A join between two
chunks is *clean* when no token can reach over it; the tokenizer's splitting pattern never puts a blank behind a
non-blank into one piece, so a join at a single blank between two non-blanks is clean. Every other join is repaired: a
window around it is encoded anew, which grows on both sides until it ends at clean places, where its ids and those of
what lies outside agree with the ids of the whole text.

The chunk store lives in a task (bounded in characters, dropped as a whole when full), not in a table: what is stored
then costs no shuffle. A table of all chunks would have to move the corpus twice to save one encoding of what repeats.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
WINDOW = 16
#: Cuts are this many characters apart on average.
MEAN_CHUNK = 192
LONGEST_CHUNK = 8192
STORE_CHARS = 16_000_000
#: The splitting pattern of the vocabulary, as its publisher gives it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str, name: str = "byte_bpe_50k"):
    """Function from a text to its ids; special tokens' strings in a text are ordinary text."""
    import tiktoken

    with open(f"{path}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def cut_points(text: str) -> list[int]:
    """Positions at which a chunk begins, without 0: blanks whose preceding window hashes low, and none further apart
    than LONGEST_CHUNK."""
    limit = 2**32 // max(1, MEAN_CHUNK // 6)  # about one character in six is a blank
    hits = [p for p in map(re.Match.start, BLANK.finditer(text, WINDOW)) if crc32(text[p - WINDOW : p].encode("utf-8", "surrogatepass")) < limit]
    out, last = [], 0
    for p in [*hits, len(text)]:
        while p - last > LONGEST_CHUNK:
            last += LONGEST_CHUNK
            out.append(last)
        if last < p < len(text):
            out.append(p)
            last = p
    return out


BLANK = re.compile(" ")
#: A single blank between two characters that are not blank: no token can reach over the place before it.
CLEAN = re.compile(r"(?<=\S) (?=\S)")


class ChunkEncoder:
    """Encodes texts by shared chunks; ``encoded`` and ``reused`` count chunks."""

    def __init__(self, encode, store_chars: int = STORE_CHARS):
        self.encode, self.limit = encode, store_chars
        self.store: dict[str, list[int]] = {}
        self.held = self.encoded = self.reused = 0

    def chunk(self, text: str) -> list[int]:
        ids = self.store.get(text)
        if ids is not None:
            self.reused += 1
            return ids
        ids = self.encode(text)
        self.encoded += 1
        self.held += len(text)
        if self.held > self.limit:
            self.store.clear()
            self.held = len(text)
        self.store[text] = ids
        return ids

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for piece in self.pieces(text):
            out += self.chunk(piece)
        return out

    @staticmethod
    def pieces(text: str) -> Iterator[str]:
        """Chunks with all joins clean. A join that isn't is replaced by a window from the last clean place before it
        to the first one behind it, or to the text's ends; joins that share a window share its encoding."""
        places = [m.start() for m in CLEAN.finditer(text)]
        begin = 0
        for p in [*cut_points(text), len(text)]:
            if p <= begin:
                continue
            k = bisect_left(places, p)
            if p == len(text) or (k < len(places) and places[k] == p):
                yield text[begin:p]
                begin = p
                continue
            before = places[k - 1] if k else 0
            if before > begin:
                yield text[begin:before]
                begin = before
            after = places[k] if k < len(places) else len(text)
            yield text[begin:after]
            begin = after


def token_ids(documents: DataFrame, path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``(doc_id, ids)``: ids of each whole text without special tokens; the empty list for empty and null texts.

    One pass without a shuffle; memory is bounded by a batch, the chunk store and the longest single text. Lone
    surrogates can't occur in parquet's UTF-8. Repeated doc_id give repeated rows, a null doc_id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ChunkEncoder(encoder(path, name))
        for batch in batches:
            ids = [enc(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")
