"""Token files: ids of whole texts at a fixed width of bits, in blocks that decode by themselves.

Documents are ranged by id, so file k holds smaller ids than file k + 1. A file is a Parquet file of block
rows: documents' ids and token counts (the offsets of the block), the tokens before the block in its file,
and the packed ids. Each id takes the fewest bits that hold the vocabulary, least significant bit first. One
document is found by its block's smallest and largest id (a pushed filter) and cut out by its offsets,
without unpacking the rest. Blocks hold whole documents, so any task can decode any block.

Defined results: a null text is empty and has its end id only; rows without an id come first; repeated ids
stay separate documents, in any order among themselves; an empty table gives files without blocks; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from dispatchlake.llm.encoding import END_ID, encoder

BLOCK_TOKENS = 1 << 16  # a block is closed by the document that reaches this many ids
FILE_BYTES = 32 << 20  # of text for each file, about

BLOCKS = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("bits", pa.int32()),
        ("first_token", pa.int64()),
        ("n_tokens", pa.int64()),
        ("least_id", pa.int64()),
        ("largest_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("packed", pa.binary()),
    ]
)
BLOCKS_SQL = (
    "file int, block int, bits int, first_token long, n_tokens long, least_id long, largest_id long, "
    "doc_ids array<long>, doc_tokens array<long>, packed binary"
)
DECODED_SQL = "file int, doc_id long, first long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, least significant bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from place ``first`` on; only the bytes that hold them are touched."""
    if bits in (8, 16, 32):
        size = bits // 8
        return np.frombuffer(packed, f"<u{size}", count, first * size).astype("<u4")
    from_byte, skip = divmod(first * bits, 8)
    raw = np.frombuffer(packed, np.uint8, -(-(skip + count * bits) // 8), from_byte)
    planes = np.unpackbits(raw, bitorder="little")[skip : skip + count * bits].reshape(count, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _packer(tokenizer: str | None, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bits = width(max(encode.vocabulary, end_id + 1))
        file = TaskContext.get().partitionId()
        block, before, size, docs, counts, parts = 0, 0, 0, [], [], []

        def row() -> pa.RecordBatch:
            known = [d for d in docs if d is not None]
            packed = pack(np.frombuffer(b"".join(parts), dtype="<u4"), bits)
            bounds = (min(known), max(known)) if known else (None, None)
            values = (file, block, bits, before, size, *bounds, list(docs), list(counts), packed)
            return pa.RecordBatch.from_pylist([dict(zip(BLOCKS.names, values))], schema=BLOCKS)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1))):
                docs.append(doc)
                parts += (ids, end)
                counts.append(len(ids) // 4 + 1)
                size += counts[-1]
                if size >= BLOCK_TOKENS:
                    yield row()
                    block, before, size, docs, counts, parts = block + 1, before + size, 0, [], [], []
        if docs:
            yield row()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode whole texts and write the files below ``path``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES), min(docs.sparkSession.sparkContext.defaultParallelism, size >> 20))
    ranged = narrow.repartitionByRange(int(files), "doc_id").sortWithinPartitions("doc_id")
    blocks = ranged.mapInArrow(_packer(tokenizer, end_id), BLOCKS_SQL)
    blocks.write.option("compression", "zstd").parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for b in batch.to_pylist():
            ids, at = unpack(b["packed"], b["bits"], 0, b["n_tokens"]), 0
            for doc, n in zip(b["doc_ids"], b["doc_tokens"]):
                rows.append((b["file"], doc, b["first_token"] + at, n, zlib.crc32(ids[at : at + n])))
                at += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *[pa.int64()] * 4])],
            names=["file", "doc_id", "first", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    stored = spark.read.schema(BLOCKS_SQL).parquet(path)
    sizes = stored.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    decoded = stored.mapInArrow(_decode, DECODED_SQL)
    return decoded.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id, from the blocks that can hold it."""
    stored = spark.read.schema(BLOCKS_SQL).parquet(path)
    near = stored.filter((F.col("least_id") <= doc_id) & (F.col("largest_id") >= doc_id))
    found = []
    for b in near.orderBy("file", "block").toLocalIterator():
        at = 0
        for doc, n in zip(b["doc_ids"], b["doc_tokens"]):
            if doc == doc_id:
                found.append(unpack(b["packed"], b["bits"], at, n).tolist())
            at += n
    return found
