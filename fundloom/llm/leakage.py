"""Held-out passages inside a corpus: a broadcast hash set of test n-grams against rolling windows of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.llm.words import WORD, words
from fundloom.session import cut

RUN = 12
#: Largest number of words in all test items that is broadcast as a hash set (about 40 bytes each); beyond it the test
#: set is split into parts of this size, each scanned against the corpus.
BROADCAST_WORDS = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every ``length`` consecutive word hashes (uint64, wrapping)."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = out * BASE + h[j : j + n]
    return out


class TestSet:
    """Sorted window hashes of test items, with where each came from, by window length."""

    __test__ = False

    def __init__(self, items: list[tuple[int, np.ndarray]], run: int = RUN):
        self.words = [h for _, h in items]
        self.ids = np.array([i for i, _ in items], np.int64)
        rows: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, h in enumerate(self.words):
            if len(h):
                rows.setdefault(min(run, len(h)), []).append((windows(h, min(run, len(h))), k))
        self.by_length = {}
        for length, parts in rows.items():
            key = np.concatenate([w for w, _ in parts])
            item = np.concatenate([np.full(len(w), k) for w, k in parts])
            pos = np.concatenate([np.arange(len(w)) for w, _ in parts])
            order = np.argsort(key, kind="stable")
            self.by_length[length] = (key[order], item[order], pos[order])

    def hits(self, h: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(document, item, first word, words)`` of every verified window; ``h`` holds the word hashes of many
        documents one after another, document d from start[d] to start[d + 1]."""
        out = []
        for length, (key, item, pos) in self.by_length.items():
            w = windows(h, length)
            if not len(w):
                continue
            lo = np.searchsorted(key, w, "left")
            at = np.flatnonzero(key[np.minimum(lo, len(key) - 1)] == w)
            doc = np.searchsorted(start, at, "right") - 1
            for p, d in zip(at[at + length <= start[doc + 1]].tolist(), doc[at + length <= start[doc + 1]].tolist(), strict=True):
                k = lo[p]
                while k < len(key) and key[k] == w[p]:
                    i, q = item[k], pos[k]
                    if np.array_equal(self.words[i][q : q + length], h[p : p + length]):
                        out.append((d, int(self.ids[i]), p - int(start[d]), length))
                    k += 1
        return out


def _folded(c: str) -> Column:
    """A text whose words are, one by one, those of the text as it is written (dotted capital I is two letters in lower case)."""
    return F.translate(F.col(c), "\u0130", "i")


def _hashed(c: str) -> Column:
    return F.transform(words(_folded(c)), lambda w: F.xxhash64(w))


def leaked_spans(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``(doc_id, item_id, first, words)``: each window of ``run`` words of an item (all words of a shorter item) that a
    document holds, by the position of its first word.

    Words are hashed to 64 bits in the JVM; the scan of windows is vectorised and touches each text once, without a
    shuffle. A hit of a window's hash is verified by the hash of each of its words. The test set is broadcast as a hash
    set while it has at most BROADCAST_WORDS words (which is counted); a larger one is split by item into parts of about
    that size, and the driver holds one part at a time. Null and empty texts, and items without a word, give nothing;
    items with equal text are all reported; repeated rows repeat.
    """
    spark = documents.sparkSession
    tests = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), _hashed("text").alias("h")).distinct()
    held = tests.agg(F.coalesce(F.sum(F.size("h")), F.lit(0))).first()[0]
    parts = max(1, -(-held // BROADCAST_WORDS))
    if parts > 1:
        tests = cut(tests)

    def scan(part):
        def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests: TestSet = part.value
            for batch in batches:
                column = batch.column(1)
                start = column.offsets.to_numpy() - column.offsets[0].as_py()
                hits = tests.hits(column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), start)
                d, i, p, n = zip(*hits, strict=True) if hits else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d, pa.int64())), pa.array(i, pa.int64()), pa.array(p, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "item_id", "first", "words"])

        return run_batches

    corpus = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _hashed("text").alias("h"))
    out = None
    for k in range(parts):
        mine = tests.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k) if parts > 1 else tests
        part = TestSet([(r.item_id, np.array(r.h, np.int64).view(np.uint64)) for r in mine.collect()], run)
        found = corpus.mapInArrow(scan(spark.sparkContext.broadcast(part)), "doc_id long, item_id long, first long, words long")
        out = found if out is None else out.unionByName(found)
    return out


def leaks(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``(doc_id, item_id)``: which documents hold a run of an item, each pair once."""
    return leaked_spans(documents, items, run).select("doc_id", "item_id").distinct()


def cleaned(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """``(doc_id, words, leaked_words, kept_text)``: documents with a leak, the leaked words cut out of the text as it is
    written, with what stands before each of them. Case, punctuation and line breaks of the rest stay.

    A document's windows are merged to spans that don't touch, so a word is looked for in a few spans. Rows of one
    doc_id are cut by the windows of any of them where their texts differ; null doc_id and null texts give no row.
    """
    spans = leaked_spans(documents, items, run).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("words")).alias("end")))).alias("windows"))
    last = lambda acc: F.element_at(acc, -1)
    join = lambda acc, x: F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["end"], x["end"]).alias("end"))))
    merged = F.aggregate(F.slice("windows", F.lit(2), F.size("windows")), F.slice("windows", 1, 1), lambda acc, x: F.when(x["first"] <= last(acc)["end"], join(acc, x)).otherwise(F.concat(acc, F.array(x))))
    # A piece is a word with what stands before it; what follows the last word is the tail.
    x = documents.select("doc_id", "text", F.regexp_extract_all("text", F.lit(rf"(?s)[^\p{{L}}\p{{N}}]*{WORD}"), F.lit(0)).alias("p")).join(spans.select("doc_id", merged.alias("gone")), "doc_id").withColumn("n", F.size("p")).where("n > 0")
    kept = F.filter("p", lambda w, i: ~F.exists("gone", lambda g: (i >= g["first"]) & (i < g["end"])))
    tail = F.substr("text", F.length(F.array_join("p", "")) + 1)
    return x.select("doc_id", F.col("n").cast("long").alias("words"), (F.col("n") - F.size(kept)).cast("long").alias("leaked_words"), F.concat(F.array_join(kept, ""), tail).alias("kept_text"))
