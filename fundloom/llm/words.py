"""Words as the data's documentation defines them: maximal runs of letters and digits, in lower case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for empty and null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def shingles(w: Column, k: int) -> Column:
    """Distinct 64-bit hashes of the sequences of ``k`` consecutive words, sorted; empty for fewer words."""
    rows = F.transform(F.sequence(F.lit(1), F.size(w) - F.lit(k - 1)), lambda i: F.xxhash64(*[F.element_at(w, (i + j).cast("int")) for j in range(k)]))
    return F.when(F.size(w) >= k, F.sort_array(F.array_distinct(rows))).otherwise(F.array().cast("array<bigint>"))
