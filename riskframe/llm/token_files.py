"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Format (a folder):

* ``vocabulary``: Parquet ``(rank, id, n)``; rank 0 is the most frequent id
  (ties: the smaller id).
* ``blocks``: Parquet, one row per block of consecutive documents, at most
  ``BLOCK_TOKENS`` tokens unless one document is longer:
  ``shard`` (ordered by document id), ``first`` (tokens of the shard before the
  block), ``doc_ids``, ``n_tokens`` (array per document), ``control`` and
  ``data``. Each id is stored as its rank in 1 to 4 little-endian bytes in
  ``data``; ``control`` holds the byte counts less one, two bits an id, four ids
  a byte, low bits first.

Reading looks up the four lengths of every control byte in a 256-row table,
turns them into offsets with one cumulative sum and gathers the values.

Documents are ordered by id (null first), ties by the first 64 characters
of the text, then by its hash: different texts of one id spread over tasks. Null
and empty texts hold the end id alone. Repeated rows are separate documents. An empty table
gives an empty folder of blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, in_order, texts_of
from riskframe.llm.encode import encoder
from riskframe.session import shared_path

BLOCK_TOKENS = 1 << 16
ENCODED = "shard int, doc_id long, first long, ids binary, counts binary"
BLOCKS = "shard int, first long, doc_ids array<long>, n_tokens array<long>, control binary, data binary"


# ---- the code ---------------------------------------------------------------

#: Row c: the four byte counts that control byte c stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[:len(values)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths)
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    at = ends - lengths
    words = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24 if n else raw[:0]
    return words & KEEP[lengths]


# ---- writing ----------------------------------------------------------------

def _encoded(docs: DataFrame, tokenizer_json, end_id: int) -> DataFrame:
    """Ids of every document in order, with the shard (a range of document ids)
    and the tokens of the shard before the document. The last row of a task holds
    how often each id came up in it, in ``counts``; elsewhere that is null."""
    ordered = in_order(docs).withColumn("shard", F.spark_partition_id())

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_json.value)
        wide = np.dtype("<u4")
        end = np.array([end_id], enc.dtype if end_id < 1 << 16 else wide).tobytes()
        first, counts, f = 0, np.zeros(max(enc.size, end_id + 1), "<i8"), None
        for f in frames:
            ids = [enc.ids(t) + end for t in f["text"]]
            n = np.array([len(x) // enc.dtype.itemsize for x in ids], np.int64)
            yield pd.DataFrame({"shard": f["shard"], "doc_id": f["doc_id"].astype("Int64"),
                                "first": first + np.cumsum(n) - n, "ids": ids, "counts": None})
            first += int(n.sum())
            for k in range(0, len(ids), 64):
                counts += np.bincount(np.frombuffer(b"".join(ids[k:k + 64]), enc.dtype), minlength=len(counts))
        if f is not None:
            yield pd.DataFrame({"shard": f["shard"].iloc[:1], "doc_id": pd.array([None], "Int64"), "first": first,
                                "ids": None, "counts": [counts.tobytes()]})

    return ordered.mapInPandas(encode, ENCODED)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1,
                      key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text with the tokenizers file, append ``end_id`` and
    write the folder ``path``. Texts go through the tokenizer once: the plain ids
    rest in the shared folder, with the frequencies that each task counted. Only the
    vocabulary (its size is fixed by the tokenizer) passes through the driver."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    shared = spark.sparkContext.broadcast(source)
    own = encoder(source)
    dtype, size = own.dtype, max(own.size, end_id + 1)
    bounded_batches(spark)
    rest = shared_path(spark, "token-ids")
    (_encoded(texts_of(docs, key, text), shared, end_id)
     .write.option("compression", "zstd").parquet(rest))
    rows = spark.read.schema(ENCODED).parquet(rest)
    plain = rows.where("counts is null").drop("counts")

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, np.int64)
        for f in frames:
            for counts in f["counts"]:
                n += np.frombuffer(counts, "<i8")
        found = np.flatnonzero(n)
        yield pd.DataFrame({"id": found, "n": n[found]})

    counts = (rows.where("counts is not null").select("counts").mapInPandas(tally, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts.sort(key=lambda r: (-r["n"], r["id"]))
    vocabulary = [(k, r["id"], r["n"]) for k, r in enumerate(counts)]
    (spark.createDataFrame(vocabulary, "rank int, id long, n long").coalesce(1)
     .write.parquet(f"{path}/vocabulary"))
    rank = np.zeros(size, np.uint32)
    rank[[r[1] for r in vocabulary]] = np.arange(len(vocabulary))
    ranks = spark.sparkContext.broadcast(rank)

    def block(rows: list[tuple]) -> tuple:
        values = ranks.value[np.frombuffer(b"".join(r[3] for r in rows), dtype)]
        sizes = [len(r[3]) // dtype.itemsize for r in rows]
        return rows[0][0], rows[0][2], [r[1] for r in rows], sizes, *pack(values)

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["shard", "first", "doc_ids", "n_tokens", "control", "data"]
        rows: list[tuple] = []
        held, after = 0, None
        for f in frames:
            out = []
            ids = [None if pd.isna(d) else int(d) for d in f["doc_id"]]
            for row in zip(f["shard"], ids, f["first"], f["ids"]):
                n = len(row[3]) // dtype.itemsize
                # a block holds neighbours of one shard
                if rows and (held + n > BLOCK_TOKENS or after != (row[0], row[2])):
                    out.append(block(rows))
                    rows, held = [], 0
                rows.append(row)
                held += n
                after = (row[0], row[2] + n)
            if out:
                yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame([block(rows)], columns=names)

    plain.mapInPandas(blocks, BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")


# ---- reading ----------------------------------------------------------------

def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document and, ``with_ids``,
    its ``ids`` as little-endian unsigned 32-bit integers, which the checksum is
    of. ``start`` counts the ids of all documents before it."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    ids = spark.sparkContext.broadcast(np.array([r["id"] for r in vocabulary], "<u4"))
    # one row per shard, that is per partition of the writing job
    totals = (blocks.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
              .groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect())
    before, starts = 0, {}
    for r in totals:
        starts[r["shard"]] = before
        before += r["n"]

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = ids.value
        for f in frames:
            for b in f.itertuples(index=False):
                n = np.asarray(b.n_tokens, np.int64)
                values = table[unpack(b.control, b.data, int(n.sum()))]
                ends = np.cumsum(n)
                parts = [values[e - k:e] for e, k in zip(ends, n)]
                out = pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in b.doc_ids], "Int64"),
                    "start": starts[b.shard] + b.first + ends - n, "n_tokens": n,
                    "ids_crc32": [zlib.crc32(x) for x in parts]})
                if with_ids:
                    out["ids"] = [x.tobytes() for x in parts]
                yield out

    bounded_batches(spark, 64)
    return blocks.mapInPandas(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
