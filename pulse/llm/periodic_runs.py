"""Periodic run detection: stretches of words that repeat with a period, four times or more.

A run is a stretch with smallest period ``q`` and ``max(6, 4 * q)`` words or more that no
neighbouring word extends. Periods are searched by octaves ``[U, 2U)``. In an octave a text
has a boundary at every multiple of ``U``, and the tile of boundary ``c`` are the words from
``c - U`` to ``c + 4U``; neighbouring tiles overlap by four fifths.

* **Tiles.** A run of period ``q`` holds ``floor(3 q / U) - 1`` neighbouring boundaries at least
  whose ``U`` words stand again ``q`` words later: two, three or four. Hashes of all stretches of ``U`` words, doubled from
  octave to octave, find the boundaries where that may be so; equal stretches have equal
  hashes, so no run is lost, and texts without repeats give no tile. Neighbouring tiles of an
  octave travel as one strip of at most ``STRIP_WORDS`` words (or one tile), as numbers
  of words, dealt out over all tasks.
* **Boundary Z-functions.** In each tile one Z-function runs on from the boundary and one
  back from it. For every period of the octave they give how far the words around the
  boundary repeat: an interval, exact, up to the edges of the tile. Intervals that end inside
  their tile and are too short for a run are dropped, those of one strip joined.
* **Stitching.** Intervals are shuffled by document and period; those that share ``q`` words
  or more are one. The first boundary of a run lies within ``U`` of its start and the last
  within ``q + 2U`` of its end, so both ends show in a tile. A stretch whose period has a
  divisor that is a period too has the same interval under the smaller one, and the
  smallest period of equal intervals stays.

Texts without tiles are finished where they are read; only others travel, with their runs.

Bounds: a task holds one batch of texts (16 MB, or one text) with a few numbers per word,
or one strip. A text gives at most about one interval per strip and period; they gather per
document and period, runs per document, both below the number of its words.

Defined cases: null text has no words; a null ``doc_id`` is a document like any other, and
rows that repeat give a result each; a text of any length is searched whole; an empty table
gives no rows; columns but ``doc_id`` and ``text`` are not looked at.
"""

import hashlib
import zlib

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.session import shared_folder

REPEATS = 4
LEAST = 6
STRIP_WORDS = 1 << 15
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def split_words(doc_id, text):
    """Runs of anything but the six white space characters, as bytes."""
    return text.split()


def planted_words(doc_id, text):
    """As ``split_words``, but the end of every tenth document or so is made periodic."""
    words = text.split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


# --- tiles -------------------------------------------------------------------------------


def _mixed(x):
    x = x * _ODD[0]
    return (x ^ (x >> np.uint64(29))) * _ODD[1]


def _candidates(hashes, unit):
    """Boundaries, in units, whose ``unit`` words may stand again a period of the octave
    later, as do those of as many neighbours as a run of that period holds."""
    rows = len(hashes) // unit
    if rows < 3:
        return np.empty(0, np.int64)
    table = hashes[: rows * unit].reshape(rows, unit)
    again = table[:-1, :1] == table[1:, :]
    if not again.any():
        return np.empty(0, np.int64)
    # a run of period q holds (3 q - unit) / unit boundaries that match, rounded down, or more
    hold = again.copy()
    for part in (0, 1, 2):
        first = -(-part * unit // 3)
        need = again[: len(again) - 1 - part, first:].copy()
        for k in range(1, 2 + part):
            need &= again[k : len(again) - 1 - part + k, first:]
        hold[:, first:] = False
        for k in range(2 + part):
            hold[k : k + len(need), first:] |= need
    both = np.zeros(rows, bool)
    both[:-1] = hold.any(axis=1)
    return np.flatnonzero(both)


def strips(texts):
    """``(text, unit, start, lead, count, ids, open_end)`` of texts given as number arrays.

    The strip begins at word ``start`` of its text; its first boundary is ``lead`` words on,
    and ``count`` boundaries follow each other. Texts lie next to each other, longest first,
    with a number of its own behind each, so that no stretch reaches over a border.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    order = [i for i in order if len(texts[i]) >= LEAST]
    if not order:
        return
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    parts = []
    for k, i in enumerate(order):
        parts += [texts[i], np.array([-1 - k], np.int64)]
    ids = np.concatenate(parts)
    hashes, unit = _mixed(ids.astype(np.uint64)), 1
    while True:
        fit = int(np.searchsorted(-sizes, -REPEATS * unit, side="right"))
        if not fit:
            return
        hashes = hashes[: begins[fit - 1] + sizes[fit - 1] + 1]
        at = _candidates(hashes, unit) * unit
        owner = np.searchsorted(begins, at, side="right") - 1
        most = max(1, STRIP_WORDS // unit)
        k = 0
        while k < len(at):
            own, last = owner[k], k + 1
            while last < len(at) and last - k < most and owner[last] == own:
                if at[last] != at[last - 1] + unit:
                    break
                last += 1
            low, high = begins[own], begins[own] + sizes[own]
            if at[k] < high:
                a, b = max(low, at[k] - unit), min(high, at[last - 1] + 4 * unit)
                yield (
                    order[own], unit, int(a - low), int(at[k] - a), last - k,
                    ids[a:b].astype(np.int32), bool(b < high),
                )
            k = last
        shifted = np.zeros_like(hashes)
        shifted[:-unit] = hashes[unit:]
        hashes = _mixed(hashes + _ODD[1] * shifted)
        unit *= 2


_TABLE = (
    "key bigint, doc_id bigint, whole string, text binary, unit int, start bigint, lead int, "
    "count int, ids binary, open_end boolean"
)


def _tile(words_of):
    def run(batches, schema):
        for batch in batches:
            keys, docs, texts = (c.to_pylist() for c in batch.columns)
            code, numbers, wholes = {}, [], []
            for doc, text in zip(docs, texts):
                words = words_of(doc, text or b"")
                numbers.append(
                    np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
                )
                wholes.append(hashlib.sha256(b" ".join(words)).hexdigest())
            found = list(strips(numbers))
            tiled = {s[0] for s in found}
            out = [
                keys, docs, wholes, [t or b"" if i in tiled else None for i, t in enumerate(texts)],
                *[[None] * len(keys) for _ in range(6)],
            ]
            yield record_batch(schema, out)
            for k in range(0, len(found), 1000):
                some = found[k : k + 1000]
                nothing = [None] * len(some)
                yield record_batch(
                    schema,
                    [
                        [keys[s[0]] for s in some], nothing, nothing, nothing,
                        *[[s[c] for s in some] for c in (1, 2, 3, 4)],
                        [s[5].tobytes() for s in some], [s[6] for s in some],
                    ],
                )

    return run


# --- boundary Z-functions ----------------------------------------------------------------


def z_values(s, most):
    """For each place below ``most`` how many items from there on equal the first ones."""
    n = len(s)
    most = min(most, n)
    z = [0] * most
    left = right = 0
    for i in range(1, most):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def least_length(period):
    return max(LEAST, REPEATS * period)


def solve_strip(ids, unit, start, lead, count, open_end):
    """``(period, start, end)`` intervals of the text that repeat, seen from the strip."""
    words, held = ids.tolist(), {}
    for c in range(lead, lead + count * unit, unit):
        low, high = max(0, c - unit), min(len(words), c + 4 * unit)
        cut_left = low + start > 0
        cut_right = high < len(words) or open_end
        on = z_values(words[c:high], 2 * unit)
        periods = [q for q in range(unit, len(on)) if on[q] >= unit]
        least = next((p for p in range(1, min(unit, len(on))) if p + on[p] >= 2 * unit), 0)
        if least:  # where the words have this period too, a multiple is no smallest one
            periods = [q for q in periods if q % least or least + on[least] < q + on[q]]
        if not periods:
            continue
        top = min(high, c + 2 * unit - 1)
        before = words[low:c][::-1]
        back = z_values(before + [None] + words[low:top][::-1], len(before) + 1 + top - low)
        skip = len(before) + 1
        for q in periods:
            came = min(back[skip + top - c - q], len(before)) if before else 0
            a, b = c - came, c + q + on[q]
            inside = not (cut_left and a == low) and not (cut_right and b == high)
            if inside and b - a < least_length(q):
                continue
            last = held.get(q)
            if last and a + q <= last[1]:
                last[0], last[1] = min(a, last[0]), max(b, last[1])
            else:
                if last:
                    yield q, start + last[0], start + last[1]
                held[q] = [a, b]
    for q, (a, b) in held.items():
        yield q, start + a, start + b


def _solve(batches, schema):
    for batch in batches:
        out = [[], [], [], []]
        for key, unit, start, lead, count, ids, open_end in zip(*(c.to_pylist() for c in batch.columns)):
            for found in solve_strip(np.frombuffer(ids, np.int32), unit, start, lead, count, open_end):
                for column, value in zip(out, (key, *found)):
                    column.append(value)
        yield record_batch(schema, out)


# --- stitching ---------------------------------------------------------------------------


def stitch(fragments):
    """``key, period, start, end`` of maximal intervals, from pieces that share a period."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") + F.col("period") > reached, F.lit(True))
    marked = fragments.withColumn("new", new.cast("int"))
    numbered = marked.withColumn("run", F.sum("new").over(order))
    return (
        numbered.groupBy("key", "period", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("run")
    )


def _runs(table):
    """``key, runs``: the runs of every document that has any."""
    tiles = table.where("unit IS NOT NULL").select(
        "key", "unit", "start", "lead", "count", "ids", "open_end"
    )
    # small rows with much work: not joined to few tasks by their bytes
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = map_arrow(
        tiles.repartition(parts, "key", "unit", "start"), _solve,
        "key bigint, period bigint, start bigint, end bigint",
    )
    length = F.col("end") - F.col("start")
    long_enough = length >= F.greatest(F.lit(LEAST), REPEATS * F.col("period"))
    smallest = (
        stitch(fragments).where(long_enough)
        .groupBy("key", "start", "end")
        .agg(F.min("period").alias("period"))
    )
    run = F.struct("start", length.alias("length"), "period")
    return smallest.groupBy("key").agg(F.sort_array(F.collect_list(run)).alias("runs"))


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _collapse(words_of):
    def run(batches, schema):
        for batch in batches:
            docs, wholes, texts, runs = (c.to_pylist() for c in batch.columns)
            digests = []
            for doc, whole, text, own in zip(docs, wholes, texts, runs):
                if own:
                    words = words_of(doc, text)
                    keep = np.ones(len(words), bool)
                    for r in own:
                        keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
                    kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                    whole = hashlib.sha256(kept).hexdigest()
                digests.append(whole)
            yield record_batch(schema, [docs, runs, digests])

    return run


def find_runs(docs, words_of=split_words):
    """``doc_id, runs, collapsed_sha256`` for every row.

    ``runs`` by start, then period. The digest is that of the words left, joined by one
    space, when every run is cut to its first period. ``words_of(doc_id, text)`` gives the
    words of a text as bytes.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    folder = shared_folder(spark, "run-tiles")
    map_arrow(rows, _tile(words_of), _TABLE).write.parquet(folder)
    table = spark.read.parquet(folder)
    texts = table.where("unit IS NULL")
    plain = texts.where("text IS NULL").select(
        "doc_id", F.array().cast(_RUNS).alias("runs"), F.col("whole").alias("collapsed_sha256")
    )
    # a merge join at every size: a small table of runs would be broadcast, a large one not
    found = spark.read.parquet(_written(_runs(table), "runs")).hint("merge")
    tiled = texts.where("text IS NOT NULL").join(found, "key", "left").select(
        "doc_id", "whole", "text", F.coalesce("runs", F.array().cast(_RUNS)).alias("runs")
    )
    ddl = f"doc_id bigint, runs {_RUNS}, collapsed_sha256 string"
    return plain.unionByName(map_arrow(tiled, _collapse(words_of), ddl))


def _written(df, purpose):
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return folder


def digest(found):
    """The longest run and the digests of every row of ``find_runs``."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("before"),
                (-r["period"]).alias("small"),
            ),
        )
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(
            r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
            r["period"].cast("string"), F.lit("\n"),
        ),
    )
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.before")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.small")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.small)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(find_runs(docs, planted_words))
