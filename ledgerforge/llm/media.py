"""Media columns as content-defined chunks.

A payload is cut where a rolling gear hash of its last 32 bytes hits a mask, so equal passages give
equal chunks wherever they stand. Chunks are named by digest. The digests of all ordered chunk lists are counted;
a Spark aggregation keeps each chunk that is listed more than once (the store), and the lists are joined with it.
A chunk that is listed once goes straight to its medium. So payloads are read back, every chunk and the whole
verified. The stored form of a medium is its list of digests and lengths followed by
its distinct chunks as raw 8-bit samples; between tasks chunks travel compressed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerforge.llm import common

UNIT = 576
LEAST, MASK_BITS, MOST = 1024, 12, 32768
GEAR = (common.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
MAGIC = b"CDC1"


def padded(data: bytes) -> bytes:
    """Bytes 255 are appended up to a positive multiple of 576."""
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT)


def cuts(payload: bytes) -> list[int]:
    """Ends of the chunks. The gear hash of 32 bytes is built by doubling, five passes for all positions."""
    if len(payload) <= LEAST:
        return [len(payload)]
    h = GEAR[np.frombuffer(payload, np.uint8)]
    for span in (1, 2, 4, 8, 16):
        h[span:] += h[:-span].copy() << np.uint32(span)
    marks = np.flatnonzero((h >> np.uint32(32 - MASK_BITS)) == 0) + 1
    out, last = [], 0
    for m in [*marks.tolist(), len(payload)]:
        while m - last > MOST:
            last += MOST
            out.append(last)
        if m - last >= LEAST or m == len(payload) > last:
            out.append(m)
            last = m
    return out


def chunks(payload: bytes) -> list[bytes]:
    ends = cuts(payload)
    return [payload[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def digest(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()[:16]


def stored(parts: list[bytes]) -> bytes:
    """The stored form of a medium."""
    names = [digest(p) for p in parts]
    distinct = dict(zip(names, parts, strict=True))
    return b"".join([MAGIC, len(parts).to_bytes(4, "big"), *(n + len(p).to_bytes(4, "big") for n, p in zip(names, parts, strict=True)), *distinct.values()])


def read(form: bytes) -> bytes:
    """The payload of a stored form; raises ValueError if a chunk is not what its digest says."""
    if form[:4] != MAGIC:
        raise ValueError("not a chunked medium")
    n, at = int.from_bytes(form[4:8], "big"), 8
    listed = [(form[at + 20 * i : at + 20 * i + 16], int.from_bytes(form[at + 20 * i + 16 : at + 20 * i + 20], "big")) for i in range(n)]
    at += 20 * n
    known: dict[bytes, bytes] = {}
    for name, length in listed:
        if name not in known:
            known[name] = form[at : at + length]
            at += length
            if digest(known[name]) != name:
                raise ValueError("chunk does not match its digest")
    return b"".join(known[name] for name, _ in listed)


def feature(payload: bytes, parts: int, distinct: int) -> str:
    """Chunks, distinct chunks, mean, deviation and entropy of the samples."""
    n = np.bincount(np.frombuffer(payload, np.uint8), minlength=256).astype(np.float64)
    p = n / n.sum()
    mean = float(p @ np.arange(256))
    spread = float(p @ (np.arange(256) - mean) ** 2) ** 0.5
    entropy = float(-(p[p > 0] * np.log2(p[p > 0])).sum())
    return f"chunks={parts};distinct={distinct};mean={mean:.6f};std={spread:.6f};entropy={entropy:.6f}"


def sample(docs: DataFrame, buckets: int = 96, snippet: int = 1024) -> bytes:
    """A dictionary for chunks on their way, about 100 KB: the text of least hash of each bucket."""
    rows = docs.select("text").where("length(text) > 0").withColumn("h", F.xxhash64("text"))
    least = [r[0] for r in rows.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.min("h").alias("h")).select("h").collect()]
    found = rows.where(F.col("h").isin(least)).groupBy("h").agg(F.min(F.substring("text", 1, snippet)).alias("t")).collect() if least else []
    return "\n".join(r["t"] for r in sorted(found, key=lambda r: r["h"])).encode()


def _distinct_payloads(stream: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, list[bytes]]]]:
    """Name and chunks of the payloads of each batch that the task has not met before."""
    seen: set[bytes] = set()
    for batch in common.batches(stream):
        out = []
        for text in batch.column(0).to_pylist():
            payload = padded((text or "").encode())
            key = hashlib.sha256(payload).digest()
            if key not in seen:
                seen.add(key)
                out.append((key, chunks(payload)))
        yield out


def _rows(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))


def _packer(words: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=known, write_dict_id=False, write_checksum=False)


def media(docs: DataFrame, text: str = "text") -> DataFrame:
    """(media, payload_bytes, tail_crc32, media_bytes, media_sha256, feature) of each distinct payload, read back from the store.

    A null text is an empty payload, equal texts are one, and an empty table gives no row; other columns are ignored.
    ``media`` is the sha256 of the payload as written; that read back is compared with it, and a payload that differs raises.
    Which chunks are listed more than once, a filter of fixed size tells; a chunk that it takes for one of them goes by the
    store too, with the same result.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    docs = docs.select(F.col(text).alias("text"))
    known = sample(docs)

    def lists(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for payloads in _distinct_payloads(stream):
            rows = [(key, i, name, _word(name)) for key, parts in payloads for i, name in enumerate(map(digest, parts))]
            yield _rows(rows, media=pa.binary(), at=pa.int32(), digest=pa.binary(), x=pa.int64())

    listed = common.written(docs.mapInArrow(lists, "media binary, at int, digest binary, x long"), "chunk-lists")
    several = listed.groupBy("digest").agg(F.min("x").alias("x"), F.count("*").alias("n")).where("n > 1")
    shared = spark.sparkContext.broadcast(common.sieve(several.select("x")))

    def stored_apart(names: list[bytes]) -> list[bool]:
        return common.sieved(shared.value, np.array([_word(n) for n in names], np.int64)).tolist()

    def once(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _packer(known)
        for payloads in _distinct_payloads(stream):
            rows = [(key, i, part) for key, parts in payloads for i, part in enumerate(parts)]
            apart = stored_apart([digest(part) for _, _, part in rows])
            rows = [(key, i, pack.compress(part)) for (key, i, part), a in zip(rows, apart, strict=True) if not a]
            yield _rows(rows, media=pa.binary(), at=pa.int32(), data=pa.binary())

    def often(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, sent = _packer(known), set()
        for payloads in _distinct_payloads(stream):
            fresh = {digest(part): part for _, parts in payloads for part in parts}
            names = [n for n, apart in zip(fresh, stored_apart(list(fresh)), strict=True) if apart and n not in sent]
            sent.update(names)
            yield _rows([(n, pack.compress(fresh[n])) for n in names], digest=pa.binary(), data=pa.binary())

    def of_store(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(stream):
            yield batch.filter(pa.array(common.sieved(shared.value, batch.column(3).to_numpy()))).select([0, 1, 2])

    store = docs.mapInArrow(often, "digest binary, data binary").groupBy("digest").agg(F.first("data").alias("data"))
    shared_parts = listed.mapInArrow(of_store, "media binary, at int, digest binary").distinct().join(store, "digest").select("media", "at", "data")
    parts = docs.mapInArrow(once, "media binary, at int, data binary").unionByName(shared_parts)
    parts = parts.groupBy("media").agg(F.collect_list(F.struct("at", "data")).alias("parts"))  # chunks of one medium

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        for batch in common.batches(stream):
            rows = []
            for key, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by_place = {p["at"]: p["data"] for p in found.as_py()}
                pieces = [unpack.decompress(by_place[i]) for i in sorted(by_place)]
                form = stored(pieces)
                payload = read(form)
                if hashlib.sha256(payload).digest() != key:
                    raise ValueError(f"payload {key.hex()} was not read back whole")
                rows.append((key, len(payload), zlib.crc32(payload[-32:]), len(form), hashlib.sha256(form).hexdigest(), feature(payload, len(pieces), len(set(pieces)))))
            yield _rows(rows, media=pa.binary(), payload_bytes=pa.int64(), tail_crc32=pa.int64(), media_bytes=pa.int64(), media_sha256=pa.string(), feature=pa.string())

    return parts.mapInArrow(run, "media binary, payload_bytes long, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def _word(name: bytes) -> int:
    return int.from_bytes(name[:8], "big", signed=True)


def columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) for each row.

    A null text counts as empty (one unit of padding); equal texts share one medium; repeated rows and null ids are rows like
    others; whole texts are stored, whatever their length; extra columns are ignored.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    n = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    pad = F.when(n == 0, F.lit(UNIT)).otherwise(F.pmod(-n, F.lit(UNIT)))
    # 255 in hex, cut from a constant.
    filler = F.unhex(F.substring(F.lit("FF" * UNIT), F.lit(1), pad * 2))
    rows = docs.select("doc_id", n.cast("long").alias("n_bytes"), F.unhex(F.sha2(F.concat(data, filler), 256)).alias("media"))
    out = rows.join(media(docs, text), "media", "left")
    return out.select("doc_id", "n_bytes", "payload_bytes", F.lower(F.hex("media")).alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256", "feature")
