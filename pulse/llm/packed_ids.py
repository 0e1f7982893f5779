"""Token-id output: fixed-width bit packing with block offsets.

A body is: the four bytes ``PKI1``, bits per id (u8), ids per block (u32), number of ids
(u64), the byte offset of every block within the payload and of its end (u64 each), and the
payload. Every id takes the fewest bits that hold the vocabulary, lowest bit first; every
block begins at a byte. A block is unpacked with numpy on its own, so any range of ids can
be read without the rest.

A token table is a Parquet folder. Each row holds the ids of neighbouring documents: the
number of its part, its place in it, the ids before it in the part, the documents' ids and
lengths, and the body. Parts are ranges of ``doc_id`` in ascending order, rows are in order
inside a part. Parts are written by Spark's own writer, so any Hadoop store serves, and a
lost executor leaves no half file.

Defined cases: null text counts as empty and is stored as its end id; rows with one
``doc_id`` stand side by side, by text; null ``doc_id`` comes first; an empty table gives an
empty table; other columns are not stored.
"""

import struct

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.pieces import piece_encoder
from pulse.session import shared_folder

MAGIC = b"PKI1"
BLOCK = 4096  # ids, a multiple of 8
ROW_IDS = 1 << 19  # ids after which a row is closed
_HEAD = struct.Struct("<4sBIQ")


def bits_for(vocabulary):
    """Bits that hold every id of a vocabulary of this size."""
    return max(1, (vocabulary - 1).bit_length())


def _pack_block(ids, bits):
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8), bitorder="little").tobytes()


def _unpack_block(data, bits, count):
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    weights = (1 << np.arange(bits, dtype=np.uint64)).astype(np.uint64)
    return (spread.reshape(count, bits) @ weights).astype(np.uint32)


def pack(ids, bits, block=BLOCK):
    """A body holding ``ids``."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) and bits < 32 and int(ids.max()) >> bits:
        raise ValueError(f"an id takes more than {bits} bits")
    blocks = [_pack_block(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return _HEAD.pack(MAGIC, bits, block, len(ids)) + offsets.tobytes() + b"".join(blocks)


def unpack(body, start=0, stop=None):
    """Ids ``start`` to ``stop`` of a body; only the blocks they lie in are unpacked."""
    magic, bits, block, count = _HEAD.unpack_from(body)
    if magic != MAGIC:
        raise ValueError("this is no body of packed ids")
    stop = count if stop is None else min(stop, count)
    if start >= stop:
        return np.empty(0, np.uint32)
    n_blocks = -(-count // block)
    offsets = np.frombuffer(body, "<u8", n_blocks + 1, _HEAD.size)
    payload = _HEAD.size + 8 * (n_blocks + 1)
    first, last = start // block, (stop - 1) // block
    parts = [
        _unpack_block(
            body[payload + int(offsets[k]) : payload + int(offsets[k + 1])],
            bits,
            min(block, count - k * block),
        )
        for k in range(first, last + 1)
    ]
    return np.concatenate(parts)[start - first * block : stop - first * block]


_TABLE = (
    "part int, place int, before bigint, n_ids bigint, doc_ids array<bigint>,"
    " lengths array<bigint>, body binary"
)


def _write(path, end_id):
    def run(batches, schema):
        from pyspark import TaskContext

        encoder = piece_encoder(path, "<u4")
        bits = bits_for(encoder.vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        part, place, before = TaskContext.get().partitionId(), 0, 0
        docs, lengths, held, total = [], [], [], 0

        def close():
            nonlocal place, before, total
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [place], [before], [total], [list(docs)], [list(lengths)], [pack(ids, bits)]]
            place, before, total = place + 1, before + total, 0
            docs.clear(), lengths.clear(), held.clear()
            return record_batch(schema, row)

        for batch in batches:
            texts = encoder.texts(batch.column(1).to_pylist())
            for doc, ids in zip(batch.column(0).to_pylist(), texts):
                ids += end
                docs.append(doc), lengths.append(len(ids) // 4), held.append(ids)
                total += lengths[-1]
                if total >= ROW_IDS:
                    yield close()
        if docs:
            yield close()

    return run


def write_tokens(docs, folder, path, end_id=2):
    """Encode ``docs`` and write them as a token table."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(ordered, _write(path, end_id), _TABLE).write.parquet(folder)
    return folder


def _read(batches, schema):
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for part, before, docs, lengths, body in zip(*columns):
            ids = unpack(body).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            yield record_batch(
                schema,
                [
                    [part] * len(docs),
                    docs,
                    (before + starts).tolist(),
                    lengths,
                    [ids[a:b].tobytes() for a, b in zip(starts, ends)],
                ],
            )


def read_tokens(spark, folder):
    """``doc_id, start, n_tokens, ids`` for every document of a token table.

    ``start`` counts the ids of all documents before, ``ids`` are little-endian unsigned
    32-bit integers.
    """
    table = spark.read.schema(_TABLE).parquet(folder)
    documents = map_arrow(
        table.select("part", "before", "doc_ids", "lengths", "body"),
        _read,
        "part int, doc_id bigint, in_part bigint, n_tokens bigint, ids binary",
    )
    # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        table.groupBy("part")
        .agg(F.sum("n_ids").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    )
    return documents.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("first") + F.col("in_part")).alias("start"), "n_tokens", "ids"
    )


def read_range(spark, folder, part, start, stop):
    """Ids ``start`` to ``stop`` of one part: reads only the rows they lie in."""
    table = spark.read.schema(_TABLE).parquet(folder)
    rows = (
        table.where(
            (F.col("part") == part)
            & (F.col("before") < stop)
            & (F.col("before") + F.col("n_ids") > start)
        )
        .select("before", "body")
        .orderBy("before")
        .collect()
    )
    parts = [unpack(r.body, max(0, start - r.before), stop - r.before) for r in rows]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def query(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = write_tokens(
        docs, shared_folder(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
