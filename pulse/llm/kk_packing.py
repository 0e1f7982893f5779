"""Packing: Karmarkar-Karp multiway differencing into windows of equal capacity.

Each task tokenises its documents and packs them in batches of about ``BATCH`` tokens, so
nothing is shuffled and a task holds one batch. A document longer than a window first
fills whole windows; what remains of it, and all shorter documents, are cut into pieces of
at most ``PIECE`` ids. Differencing starts from one partial partition per piece and always
merges the two with the largest imbalance, heaviest windows of one onto the lightest of
the other, until one partition is left with near-equal windows. It begins with the fewest
windows that can hold the batch, and their number rises while one exceeds the capacity.
Pieces of one document that meet in a window stand there in order.

Window numbers are the task's number and a count, so a task that runs again gives the
same ones. Padding is what a window lacks to its capacity.

Defined cases: null text counts as empty and packs as its end id alone; repeated rows are
documents of their own; documents without id keep a null id; an empty table gives no rows;
other columns are not looked at.
"""

import heapq

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.pieces import piece_encoder

CAPACITY = 4096
PIECE = 512
BATCH = 500_000  # tokens
END_ID = 2


def difference(sizes, windows):
    """Deal items to ``windows`` near-equal groups; a list of item numbers per window.

    A partial partition keeps only its windows that are not empty, heaviest first.
    """
    heap = []
    for i, size in enumerate(sizes):
        # imbalance against an empty window is the item's size
        heap.append((-size, i, [(size, i)]))
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        room = windows - len(a)  # empty windows of the longer one
        if len(b) <= room:
            merged = a + b
        else:
            # b's heaviest go to empty windows, the rest onto a's lightest, opposed
            rest = b[room:]
            start = len(a) - len(rest)
            merged = a[:start] + b[:room]
            merged += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[start:], reversed(rest))]
        merged.sort(key=lambda w: -w[0])
        lightest = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (lightest - merged[0][0], tie, merged))
        tie += 1
    groups = []
    for _, tree in heap[0][2] if heap else []:
        items, todo = [], [tree]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += node
            else:
                items.append(node)
        groups.append(items)
    return groups


def pack_sizes(sizes, capacity=CAPACITY):
    """Groups of items of at most ``capacity``, each within one window."""
    windows = max(1, -(-sum(sizes) // capacity))
    while sizes:
        groups = difference(sizes, windows)
        over = max(sum(sizes[i] for i in g) for g in groups) - capacity
        if over <= 0:
            return groups
        windows += max(1, windows * over // (4 * capacity))
    return []


def _pieces(tokens, capacity, piece):
    """Start and length of the pieces of a document: whole windows first."""
    at = 0
    while tokens - at >= capacity:
        yield at, capacity
        at += capacity
    while at < tokens:
        size = min(piece, tokens - at)
        yield at, size
        at += size


def _pack(path, capacity, piece, end_id):
    def run(batches, schema):
        from pyspark import TaskContext

        encoder = piece_encoder(path, None, spaced=False)
        context = TaskContext.get()
        window = (context.partitionId() if context else 0) << 40
        end = np.array([end_id], encoder.dtype)
        held, total = [], 0

        def flush():
            nonlocal window
            items = [
                (n, start, size)
                for n, (_, ids) in enumerate(held)
                for start, size in _pieces(len(ids), capacity, piece)
            ]
            whole = [[i] for i, x in enumerate(items) if x[2] == capacity]
            rest = [i for i, x in enumerate(items) if x[2] < capacity]
            groups = pack_sizes([items[i][2] for i in rest], capacity)
            out = [[] for _ in schema]
            for group in whole + [[rest[k] for k in g] for g in groups]:
                offset = 0
                for i in sorted(group):
                    n, start, size = items[i]
                    doc, ids = held[n]
                    part = ids[start : start + size].astype("<u4").tobytes()
                    for column, value in zip(
                        out, (doc, start, size, part, len(ids), window, offset)
                    ):
                        column.append(value)
                    offset += size
                window += 1
            held.clear()
            return record_batch(schema, out)

        for batch in batches:
            texts = encoder.texts(batch.column(1).to_pylist())
            for doc, ids in zip(batch.column(0).to_pylist(), texts):
                ids = np.concatenate([np.frombuffer(ids, encoder.dtype), end])
                held.append((doc, ids))
                total += len(ids)
                if total >= BATCH:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    return run


def pack_documents(docs, path, capacity=CAPACITY, piece=PIECE, end_id=END_ID):
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``, one row per piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    return map_arrow(
        rows,
        _pack(path, capacity, piece, end_id),
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )


def packed_digest(docs, path=None):
    """The pieces with a checksum in place of their ids."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, path).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def query(spark, sf_dir):
    return packed_digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
