"""Helpers shared by the corpus operators: reading, shared-folder tables, vectorised tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.session import shared_dir, written  # noqa: F401

#: Rows and bytes that Spark hands to Python at once; documents can be long, so fewer than Spark's 10000.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

_LOWER = {i: i + 32 for i in range(65, 91)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, by rows and bytes. The settings are read when a query runs, so they stay; a session that
    has smaller bounds keeps them."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        held = spark.conf.get(f"spark.sql.execution.arrow.{name}")
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def id_crc(mod: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: uncorrelated words from related ones."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_TABLE = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER_BYTES = np.arange(256, dtype=np.uint8)
_LOWER_BYTES[65:91] += 32


def hash_strings(words: list[str] | pa.Array, lower: bool = False) -> np.ndarray:
    """64-bit hashes: the sum of a random number for each byte and place. ``lower``: A-Z as in lower case."""
    words = (pa.array(words, pa.large_string()) if isinstance(words, list) else words).cast(pa.large_string())
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + n + 1]
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    if lower:
        data = _LOWER_BYTES[data]
    ends = ends - ends[0]
    place = np.arange(len(data)) - np.repeat(ends[:-1], np.diff(ends))
    with np.errstate(over="ignore"):
        values = _TABLE[((place & 63) << 8) | data]
        if len(place) and place.max() > 63:
            values = values * ((place >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def split_arrow(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As ``split_words``, with the words as an Arrow array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = lists.offsets.to_numpy()
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = (offsets - offsets[0]).astype(np.int64)
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = np.flatnonzero(pc.binary_length(words.dictionary).to_numpy(zero_copy_only=False) == 0)
    if len(empty):  # white space at an end makes an empty word
        full = codes != empty[0]
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        codes = codes[full]
    return codes, offsets, words.dictionary


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words (runs without ASCII white space) of many texts at once; ``lower``: A-Z in lower case.

    Returns the word code of each word, the number of words up to each text (one longer than
    the texts) and the words of the codes, distinct but for case. Null texts have no words.
    """
    codes, offsets, words = split_arrow(texts)
    vocabulary = words.to_pylist()
    if lower:  # here and not in Arrow, whose kernel garbles sliced arrays
        vocabulary = [w.lower() if w.isascii() else w.translate(_LOWER) for w in vocabulary]
    return codes, offsets, vocabulary


def split_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``split_words`` in lower case, with hashes in place of the words."""
    codes, offsets, words = split_arrow(texts)
    return codes, offsets, hash_strings(words, lower=True)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order-sensitive hashes of all ``width``-word windows inside one text, and where they start."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    start = np.arange(n)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    inside = start + width <= ends[:n]
    return mix(out[inside]), start[inside]


def long_signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (b for b in stream if b.num_rows)


#: Bits of a sieve: 16 MiB, whatever the corpus.
SIEVE_WORDS = 1 << 21


def sieve(hashes: DataFrame) -> np.ndarray:
    """A filter of fixed size of the 64-bit hashes ``x``, one bit each: it passes all of them, and others by chance."""
    word, bit = F.pmod("x", F.lit(SIEVE_WORDS)).alias("word"), F.shiftrightunsigned("x", 40).bitwiseAND(F.lit(63)).cast("int")
    rows = hashes.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    rows = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(SIEVE_WORDS, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def sieved(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of the hashes pass."""
    return (bits[np.mod(x, SIEVE_WORDS)] >> ((x.view(np.uint64) >> np.uint64(40)) & np.uint64(63))) & np.uint64(1) > 0


def packed(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(row, i, t, asked): the rows of ``docs`` as structs, so that no column name clashes, their id and text hash, and whether (doc_id, h)
    of ``asked`` may name them. Texts stay where they are: a filter of fixed size is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve(asked.select(F.xxhash64("doc_id", "h").alias("x"))))

    @F.pandas_udf("boolean")
    def in_question(x: pd.Series) -> pd.Series:
        return pd.Series(sieved(shared.value, x.to_numpy()))

    every = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("i"), F.xxhash64("text").alias("t"))
    return every.withColumn("asked", in_question(F.xxhash64("i", "t")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no (doc_id, h) of ``gone`` names, h being the hash of the text. Only rows in question are shuffled. Null ids
    and texts match null ones, repeated rows go or stay together, an empty ``gone`` keeps all; columns may have any names."""
    gone = written(gone, "gone")
    every = packed(docs, gone)
    kept = every.where("asked").join(gone, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("h")), "left_anti")
    return every.where("not asked").select("row.*").unionByName(kept.select("row.*"))
