"""What the operators share: reading, word rules, row identity, spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The character classes of the query contracts.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Lower-cased words in order; none for null."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), NOT_WORD), "")


def row_key(doc_id: Column, text: Column) -> Column:
    """Identity of a document row: equal for repeated rows, defined for null ids and texts.

    A struct compares its null fields as equal, so it can be joined on as it stands.
    """
    return F.struct(doc_id.alias("id"), F.xxhash64(text).alias("h"))


def held_out(doc_id: Column, modulus: int) -> Column:
    """Whether crc32 of the id's text leaves remainder 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 2


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; a null row is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.cast(pa.large_string())
    n = len(wide)
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, wide.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes; a longer row stands alone."""
    if not batch.num_rows:
        return
    _, at = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
