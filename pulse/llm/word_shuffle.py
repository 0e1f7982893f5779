"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut at safe places (see ``pieces``), and a task's texts become chunks: the list
of the chunk's distinct words, by falling frequency, and every text as the positions' word
numbers. Words of all chunks are dealt out by hash, so that each distinct word is encoded in
one place, once, and its ids go back to the chunks that have it. Where a chunk's texts and
its words' ids meet, the ids are put together by position. Decoding looks every id up in the
table of the tokens' bytes.

One row per position would be 165 million rows of some 30 bytes for half a GB of input,
several times the disk the check allows. So positions are packed: a chunk sends one row per
word group, with all its words of that group, and texts travel as word numbers in three
byte planes, compressed. The two shuffles move about as many bytes as the compressed input;
texts are cut twice, once for each, which costs less than writing the chunks down.

Every step streams. A task holds one chunk, or one row of words and a bounded table of
words it has encoded; words beyond that bound may be encoded again, with equal ids.

The input is read twice and has to come in one order, as a table does; a chunk's mark tells
when it did not, and the job fails. Write other frames down first.

Defined cases: null text counts as empty; repeated rows are texts of their own; an empty
table gives no rows; other columns are not looked at.
"""

import base64
import zlib

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.pieces import cut

CHUNK_BYTES = 16 << 20  # of text
MAX_KNOWN = 300_000


def read_ranks(path):
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def token_table(path):
    """Bytes of every token, by id; ids without a token are empty."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _squeeze(data):
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data):
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31)


def _blob(strings):
    """Byte strings as one compressed string."""
    lengths = np.fromiter(map(len, strings), "<u4", len(strings))
    return _squeeze(lengths.tobytes() + b"".join(strings))


def _strings(blob, count):
    data = _expand(blob)
    ends = np.cumsum(np.frombuffer(data, "<u4", count)) + 4 * count
    starts = ends - np.frombuffer(data, "<u4", count)
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _planes(numbers):
    """Word numbers as compressed byte planes: low bytes, middle bytes, high bytes."""
    planes = np.asarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    return _squeeze(np.ascontiguousarray(planes.T).tobytes())


def _numbers(blob, count):
    planes = np.frombuffer(_expand(blob), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_CHUNKS = "chunk bigint, grp int, doc_id bigint, place int, count int, body binary, mark int"


def _chunk(groups, texts_only):
    """Arrow function: doc_id, text -> the chunks' rows of words, or of texts.

    Both come from the same scan, whose partitions and order Spark keeps, so chunks and word
    numbers are the same in both.
    """

    def run(batches, schema):
        chunk, held, size = None, [], 0

        def close():
            nonlocal chunk
            number, texts, counts = {}, [], []
            for doc, text in held:
                first, *rest = cut(text)
                words = [first] if first else []
                words += [b" " + w for w in rest]
                numbers = [number.setdefault(w, len(number)) for w in words]
                texts.append((doc, numbers))
            words = list(number)
            counts = np.zeros(len(words), np.int64)
            for _, numbers in texts:
                np.add.at(counts, numbers, 1)
            # groups by hash of the word; inside a group by falling frequency
            group = np.fromiter((zlib.crc32(w) % groups for w in words), np.int64, len(words))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            mark = zlib.crc32(b"\0".join([words[i] for i in order])) >> 1
            out = [[] for _ in schema]
            for g in range(0 if texts_only else groups):
                chosen = order[group[order] == g]
                if len(chosen):
                    body = _blob([words[i] for i in chosen])
                    numbers = _planes(rank[chosen])
                    packed = len(numbers).to_bytes(4, "little") + numbers + body
                    for column, value in zip(out, (chunk, g, None, None, len(chosen), packed, mark)):
                        column.append(value)
            for place, (doc, numbers) in enumerate(texts if texts_only else ()):
                body = _planes(rank[numbers]) if numbers else b""
                for column, value in zip(out, (chunk, None, doc, place, len(numbers), body, mark)):
                    column.append(value)
            held.clear()
            chunk += 1
            return record_batch(schema, out)

        for batch in batches:
            if chunk is None and batch.num_rows:
                chunk = batch.column(2)[0].as_py() << 32
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((doc, text or b""))
                size += len(held[-1][1])
                if size >= CHUNK_BYTES:
                    yield close()
                    size = 0
        if held:
            yield close()

    return run


def _encode_words(path, pattern):
    """Arrow function: rows of words -> rows of their ids, each distinct word once."""

    def run(batches, schema):
        import tiktoken

        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
        )
        known = {}
        for batch in batches:
            out = [[], [], [], []]
            for chunk, count, packed, mark in zip(*[c.to_pylist() for c in batch.columns]):
                split = 4 + int.from_bytes(packed[:4], "little")
                words = _strings(packed[split:], count)
                new = [w for w in words if w not in known]
                ids = {
                    w: np.array(encoding.encode_ordinary(w.decode("utf-8")), "<u2").tobytes()
                    for w in new
                }
                if len(known) + len(ids) > MAX_KNOWN:
                    known.clear()
                found = [ids[w] if w in ids else known[w] if w in known else None for w in words]
                for i, f in enumerate(found):
                    if f is None:  # the table has been emptied
                        w = words[i].decode("utf-8")
                        found[i] = np.array(encoding.encode_ordinary(w), "<u2").tobytes()
                known.update(ids)
                body = packed[:split] + _blob(found)
                for column, value in zip(out, (chunk, count, body, mark)):
                    column.append(value)
            yield record_batch(schema, out)

    return run


def _assemble(batches, schema):
    """Arrow function over rows sorted by chunk, words first: texts put together."""
    current, table, seen = None, {}, None
    for batch in batches:
        out = [[], []]
        for chunk, kind, doc, count, body, mark in zip(*[c.to_pylist() for c in batch.columns]):
            if chunk != current:
                current, table, seen = chunk, {}, mark
            if mark != seen:
                raise ValueError("the input came in another order when it was read again")
            if kind == 0:
                split = 4 + int.from_bytes(body[:4], "little")
                numbers = _numbers(body[4:split], count)
                table.update(zip(numbers.tolist(), _strings(body[split:], count)))
            else:
                if isinstance(table, dict):
                    table = [table[k] for k in range(len(table))]
                numbers = _numbers(body, count).tolist() if count else []
                ids = b"".join(map(table.__getitem__, numbers))
                out[0].append(doc)
                out[1].append(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
        yield record_batch(schema, out)


def encode(docs, path, pattern):
    """``doc_id, ids`` for every row; ``ids`` are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    groups = min(4096, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        # the scan's own partition, also where the task reads a union
        F.spark_partition_id().alias("part"),
    )
    # Cut twice rather than written down: the chunks are as large as the input.
    words = map_arrow(rows, _chunk(groups, False), _CHUNKS).repartition(groups, "grp")
    texts = map_arrow(rows, _chunk(groups, True), _CHUNKS)
    ids = map_arrow(
        words.select("chunk", "count", "body", "mark"),
        _encode_words(path, pattern),
        "chunk bigint, count int, body binary, mark int",
    )
    both = ids.select(
        "chunk", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("doc_id"), "count", "body",
        F.lit(-1).alias("place"), "mark",
    ).unionByName(
        texts.select("chunk", F.lit(1).alias("kind"), "doc_id", "count", "body", "place", "mark")
    )
    meeting = both.repartition("chunk").sortWithinPartitions("chunk", "kind", "place")
    return map_arrow(
        meeting.select("chunk", "kind", "doc_id", "count", "body", "mark"),
        _assemble,
        "doc_id bigint, ids binary",
    )


def _decode(path):
    def run(batches, schema):
        table = token_table(path)
        for batch in batches:
            texts = [
                b"".join(map(table.__getitem__, np.frombuffer(i, "<u4").tolist()))
                for i in batch.column(1).to_pylist()
            ]
            yield record_batch(
                schema, [batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts]
            )

    return run


def decode(encoded, path):
    """``doc_id, ids`` plus the decoded bytes, by the tokens' bytes."""
    return map_arrow(
        encoded.select("doc_id", "ids"), _decode(path), "doc_id bigint, ids binary, decoded binary"
    )


def query(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decode(encode(docs, path, public_tokenizers.PATTERN), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
