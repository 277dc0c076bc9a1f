"""Token-id files of fixed-width packed ids (operator 6).

The files are Parquet, so that Spark commits them as a whole and any store
holds them. A row is one block of whole documents:

    part, block   order of the blocks: ascending, as are the documents in them
    bits          width of an id: the fewest bits that hold the vocabulary
    n_tokens      ids in the block
    doc_ids, n    the block's documents and how many ids each has
    payload       the ids, ``bits`` each, most significant bit first

The offset of an id in the payload is its number times ``bits``, so any run
of ids is unpacked with numpy from its own bytes alone (:func:`unpack`).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, text_column
from .tokens import chunks, encoder

#: A block takes documents until it has this many ids.
BLOCK_TOKENS = 65_536

FILE_SCHEMA = "part int, block int, bits int, n_tokens long, doc_ids array<long>, n array<long>, payload binary"


def width(vocab_size: int) -> int:
    """Fewest bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` per id, big-endian bit order, zero bits up to the next byte."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits == 16:
        return ids.astype(">u2").tobytes()
    if bits % 8 == 0:
        return ids.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - bits // 8:].tobytes()
    out = []
    for a in range(0, len(ids), 1 << 16):  # a multiple of 8 ids ends on a byte
        own = ids[a:a + (1 << 16)]
        out.append(np.packbits(np.unpackbits(own.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits:]).tobytes())
    return b"".join(out)


def unpack(payload: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """ids ``first`` to ``first + n`` of a payload, reading only their bytes."""
    if bits == 16:
        return np.frombuffer(payload, ">u2", n, 2 * first).astype(np.uint32)
    a, b = first * bits, (first + n) * bits
    raw = np.frombuffer(payload, np.uint8, (b + 7) // 8 - a // 8, a // 8)
    if bits % 8 == 0:
        wide = np.zeros((n, 4), np.uint8)
        wide[:, 4 - bits // 8:] = raw.reshape(n, bits // 8)
        return wide.view(">u4").ravel().astype(np.uint32)
    out = np.zeros(n, np.uint32)
    step = 1 << 16
    for i in range(0, n, step):
        k = min(step, n - i)
        a = (first + i) * bits
        own = np.frombuffer(payload, np.uint8, (a + k * bits + 7) // 8 - a // 8, a // 8)
        bit = np.unpackbits(own)[a % 8:a % 8 + k * bits].reshape(k, bits)
        full = np.zeros((k, 32), np.uint8)
        full[:, 32 - bits:] = bit
        out[i:i + k] = np.packbits(full, axis=1).view(">u4").ravel()
    return out


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text and write id files in ascending doc_id order.

    Texts are dealt out by ranges of the id (null ids first), so no task holds
    more than its range. Null texts are empty; rows that share a doc_id are
    kept, next to each other; an empty table writes files without rows.
    """
    small_batches(docs.sparkSession)
    ordered = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_column(docs, f"`{text_col}`").alias("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first()))

    def blocks(batches):
        enc = encoder(tokenizer)
        bits = width(max(enc.vocab_size, end_id + 1))
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        block, held, docs_in, sizes, codes = 0, 0, [], [], []

        def row():
            data = pack(np.frombuffer(b"".join(codes), "<u4"), bits)
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            values = [part, block, bits, sum(sizes), docs_in, sizes, data]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                              names=["part", "block", "bits", "n_tokens", "doc_ids", "n", "payload"])

        for b in batches:
            for ids, texts in chunks(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for doc_id, code in zip(ids, enc.encode(texts)):
                    docs_in.append(doc_id)
                    sizes.append(len(code) // 4 + 1)
                    codes += [code, end]
                    held += sizes[-1]
                    if held >= block_tokens:
                        yield row()
                        block, held, docs_in, sizes, codes = block + 1, 0, [], [], []
        if docs_in:
            yield row()

    ordered.mapInArrow(blocks, FILE_SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Each document of the files: doc_id, start (ids of all before it),
    n_tokens, ids_crc32 (as little-endian unsigned 32-bit) and, unless
    ``digest_only``, the ids."""
    files = read_blocks(spark, path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # blocks are large rows
    schema = "part int, block int, local long, doc_id long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")

    def decode(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["payload"], r["bits"], 0, r["n_tokens"]).astype("<u4")
                ends = np.cumsum(r["n"])
                starts = ends - r["n"]
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(starts.tolist(), ends.tolist())]
                k = len(ends)
                cols = [pa.array([r["part"]] * k, pa.int32()), pa.array([r["block"]] * k, pa.int32()), pa.array(starts, pa.int64()),
                        pa.array(r["doc_ids"], pa.int64()), pa.array(r["n"], pa.int64()), pa.array(crc, pa.int64())]
                if not digest_only:
                    cols.append(pa.array([ids[a:e].astype(np.int64) for a, e in zip(starts, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = files.mapInArrow(decode, schema)
    # block offsets: prefix sums inside a part, then over the parts (a row for each)
    sizes = files.select("part", "block", "n_tokens")
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = parts.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)).alias("_part0"))
    offsets = (sizes.select("part", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_block0"))
               .join(before, "part").select("part", "block", (F.col("_part0") + F.col("_block0")).alias("_first")))
    out = rows.join(offsets, ["part", "block"]).withColumn("start", F.col("_first") + F.col("local"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *([] if digest_only else ["ids"]))
