"""Language ID by compression: the language whose dictionary encodes a text shortest.

Each language gets a raw-content zstandard dictionary made of snippets of its labelled texts.
A text is lower-cased, runs of non-letters become one space, and it is cut into blocks that are
compressed with each dictionary at one level; the whole text counts. Narrow margins are rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

OUT = "lang_pred string, score double, margin double, rejected boolean"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Snippets of each language, the language with most training rows first; equal sizes go to the first."""

    snippets: dict[str, bytes]
    level: int = 5
    block: int = 2048
    least_margin: float = 0.004


def fit(docs: DataFrame, snippets: int = 128, snippet_chars: int = 1024) -> Model:
    """Learn from ``text`` and non-null ``lang``.

    The sample is bounded: for each language at most ``snippets`` texts, the least text hash of each
    of so many hash buckets, and ``snippet_chars`` characters of each. Copies share a hash and
    so count once, and the sample does not depend on the order of the rows.
    """
    spark = docs.sparkSession
    rows = docs.select("lang", "text").where("lang is not null and text is not null and length(text) > 0")
    rows = rows.withColumn("h", F.xxhash64("text"))
    least = rows.groupBy("lang", F.pmod("h", F.lit(snippets)).alias("b")).agg(F.min("h").alias("h"), F.count("*").alias("n")).collect()
    if not least:
        return Model({})
    seen: dict[str, int] = {}
    for r in least:
        seen[r["lang"]] = seen.get(r["lang"], 0) + r["n"]
    picks = F.broadcast(spark.createDataFrame([(r["lang"], r["h"]) for r in least], "lang string, h bigint"))
    room = F.greatest(F.length("text") - snippet_chars, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.shiftright("h", 20), room).cast("int") + 1, F.lit(snippet_chars))
    taken = rows.join(picks, ["lang", "h"]).groupBy("lang", "h").agg(F.min(piece).alias("piece")).collect()
    by: dict[str, list[tuple[int, str]]] = {}
    for r in taken:
        by.setdefault(r["lang"], []).append((r["h"], r["piece"]))
    return Model({k: " ".join(letters(p) for _, p in sorted(by[k])).encode() for k in sorted(by, key=lambda k: (-seen[k], k))})


def letters(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


class Encoder:
    """The compressors of a model; one per Python task."""

    def __init__(self, model: Model):
        self.model, self.names = model, list(model.snippets)
        self.compressors = [self._compressor(content, model.level) for content in model.snippets.values()]

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=known, level=level, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, data: bytes) -> list[int]:
        step = self.model.block
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def judge(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score from 0 to 1, margin, and whether the margin is too narrow."""
        data = letters(text or "").encode()
        if not self.names or not any(c.isalpha() for c in text or ""):  # numerals such as fractions are no letters
            return "und", 0.0, 0.0, True
        sizes = self.sizes(data)
        first, *others = sorted(sizes)
        margin = (others[0] - first) / first if others else 1.0
        ease = 8 * min(1.0, 128 / len(data))
        score = 1 / sum(2.0 ** -min(200.0, (s - first) * ease) for s in sizes)
        return self.names[sizes.index(first)], score, margin, margin < self.model.least_margin


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row with ``lang_pred``, ``score``, ``margin`` and ``rejected`` added.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, as is any text when
    nothing was learned. Equal sizes go to the commonest language. Columns that have the added
    names are replaced; other columns pass through unchanged.
    """
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters
    added = [f.split()[0] for f in OUT.split(", ")]
    kept = [c for c in docs.columns if c not in added]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in common.batches(stream):
            found = [encoder.judge(t) for t in batch.column(kept.index(text)).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, *added])

    schema = docs.schema.fields
    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), OUT]))


def stage(docs: DataFrame) -> DataFrame:
    """The rows whose language is found with a clear margin; learned from their own labels. Rows without a letter go, as do all
    where nothing was learned; repeated rows and null ids are rows like others; columns may have any names."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.pandas_udf("boolean")
    def clear(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(shared.value)
        for some in texts:
            yield pd.Series([not encoder.judge(t if isinstance(t, str) else None)[3] for t in some], dtype=bool)

    return docs.where(clear("text"))
