"""Ranked lexical search: term-at-a-time with a limit on accumulators.

Terms are maximal stretches of ASCII letters and digits and of anything beyond ASCII, A-Z
lower-cased. A document's score for an item is the sum, over the item's terms with repeats, of
the term's weight times a saturated share of its occurrences, in whole numbers
(``weight_of``, ``impacts``).

* **Postings.** One pass over the texts keeps, of every document, its number of terms and the
  occurrences of the items' terms, and writes them down. Counts over the whole table (documents
  with a term, all terms, documents that hold a term) are aggregates of that table.
* **Search.** Each task takes its documents in blocks and ranks every item against a block.
  An item's terms are taken rarest first. As long as the terms left could lift a document not
  seen yet to the block's k-th best sum, each document met gets an accumulator. Once the sum
  of the largest shares that the terms left can add is below that, no accumulator is
  created any more; those there are, are brought up to date by all terms left, so their
  scores are exact. The k-th best of a task's earlier blocks counts as well.
* **Ranking.** A task sends the k best documents of each item. They are ranked in groups first,
  then together, so no task sees more than a small share of what all tasks send.

The limit is exact: a document without an accumulator ends below the k-th best score, and
equal scores are never cut before they are ordered by ``doc_id``.

Bounds: items are searched in slices of about ``SLICE_CHARS`` characters, dealt by a hash of
``item_id``; only a slice's items and the weights of its terms go to the driver and tasks. A
block holds at most ``BLOCK_DOCS`` documents and about ``BLOCK_POSTINGS`` postings (one document
may have as many as the slice has terms). Results of a task: k rows per item.

Defined cases: null text has no terms and is not counted; documents with null ``doc_id`` come
last among equal scores, and rows that share a ``doc_id`` are ranked each; items with one
``item_id`` (null too) are one item with the terms of all; items without a term found give no
row; an empty table on either side gives no rows; other columns are not looked at.
"""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.session import shared_folder

TOP = 10
SLICE_CHARS = 4 << 20
BLOCK_DOCS = 1 << 14
BLOCK_POSTINGS = 1 << 21
GROUPS = 64  # groups an item's candidates are ranked in first
SATURATION = 8
LENGTH_SHARE = 75
UNIT = 1_000_000_000
_LETTERS = bytes(
    (c + 32 if 65 <= c <= 90 else c)
    if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122
    else 32
    for c in range(256)
)
_LAST = (1 << 63) - 1


def terms_of(text):
    """Terms of a text given as UTF-8 bytes; bytes from 128 on belong to letters."""
    return text.translate(_LETTERS).split()


def weight_of(documents, holding):
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(times, sizes, documents, terms):
    """What a weight is multiplied with: arrays of occurrences and of document sizes."""
    times, sizes = np.asarray(times, np.int64), np.asarray(sizes, np.int64)
    if len(sizes) and LENGTH_SHARE * int(sizes.max()) * documents >= 1 << 63:
        shares = [LENGTH_SHARE * int(n) * documents // terms for n in sizes]
        shares = np.array(shares, np.int64)
    else:
        shares = LENGTH_SHARE * sizes * documents // max(terms, 1)
    m = 100 - LENGTH_SHARE + shares
    return UNIT * times // (1000 * times + SATURATION * m)


# --- postings ----------------------------------------------------------------------------


def _post(vocabulary):
    def run(batches, schema):
        get = vocabulary.get
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            sizes, terms, times = [], [], []
            for text in texts:
                words = terms_of(text or b"")
                sizes.append(len(words))
                counts = {}
                for t in map(get, words):
                    if t is not None:
                        counts[t] = counts.get(t, 0) + 1
                terms.append(list(counts))
                times.append(list(counts.values()))
            yield record_batch(schema, [ids, sizes, terms, times])

    return run


def postings(docs, vocabulary):
    """``doc_id, size, terms, times`` of every row, for the terms that have a number."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    table = map_arrow(
        rows, _post(vocabulary), "doc_id bigint, size bigint, terms array<int>, times array<int>"
    )
    folder = shared_folder(docs.sparkSession, "postings")
    table.write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


# --- search ------------------------------------------------------------------------------


def _kth(values, k):
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


class Block:
    """Documents of one task with their postings by term, each list by place of the document."""

    def __init__(self, ids, sizes, terms, times, documents, all_terms):
        counts = np.array([len(t) for t in terms], np.int64)
        flat = np.fromiter((x for t in terms for x in t), np.int64, int(counts.sum()))
        shares = np.fromiter((x for t in times for x in t), np.int64, len(flat))
        place = np.repeat(np.arange(len(ids)), counts)
        worth = impacts(shares, np.repeat(np.asarray(sizes, np.int64), counts), documents, all_terms)
        order = np.argsort(flat, kind="stable")
        flat, self.place, self.worth = flat[order], place[order], worth[order]
        self.terms, starts = np.unique(flat, return_index=True)
        ends = np.append(starts[1:], len(flat))
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(self.terms, starts, ends)}
        self.most = {t: int(self.worth[a:b].max()) for t, (a, b) in self.lists.items()}
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.null = np.array([i is None for i in ids], bool)

    def search(self, item, k, floor=0):
        """``(score, place)`` arrays of the k best documents, all that equal the k-th included.

        ``item`` is ``[(term, weight with repeats)]``, rarest first. ``floor`` is a score that
        k documents have reached elsewhere.
        """
        item = [(t, w) for t, w in item if t in self.lists]
        left = sum(w * self.most[t] for t, w in item)
        none = np.empty(0, np.int64)
        if not item or left < floor:
            return none, none
        sums, seen = np.zeros(len(self.ids), np.int64), 0
        for at, (term, weight) in enumerate(item):
            a, b = self.lists[term]
            sums[self.place[a:b]] += weight * self.worth[a:b]
            share = weight * self.most[term]
            seen, left = seen + share, left - share
            if left < max(seen, floor) and left < max(floor, _kth(sums, k)):
                break
        own = np.flatnonzero(sums)
        for term, weight in item[at + 1 :]:  # no new accumulators
            a, b = self.lists[term]
            place, worth = self.place[a:b], self.worth[a:b]
            if 8 * len(own) < len(place):
                where = np.searchsorted(place, own)
                there = where < len(place)
                there[there] = place[where[there]] == own[there]
                sums[own[there]] += weight * worth[where[there]]
            else:
                there = sums[place] > 0
                sums[place[there]] += weight * worth[there]
        scores = sums[own]
        least = max(floor, _kth(scores, k), 1)
        best = np.flatnonzero(scores >= least)
        return scores[best], own[best]


def best_of(scores, ids, null, k):
    """The k best: highest score, then smallest id, null last."""
    order = np.lexsort((ids, null, -scores))[:k]
    return scores[order], ids[order], null[order]


def _search(items, documents, all_terms, k):
    def blocks(batches):
        held, n = [[], [], [], []], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[2]:
                    for column, value in zip(held, row):
                        column.append(value)
                    n += len(row[2])
                if len(held[0]) >= BLOCK_DOCS or n >= BLOCK_POSTINGS:
                    yield held
                    held, n = [[], [], [], []], 0
        if held[0]:
            yield held

    def run(batches, schema):
        best = {}
        for held in blocks(batches):
            block = Block(*held, documents, all_terms)
            for number, item in items.items():
                before = best.get(number)
                floor = int(before[0][-1]) if before and len(before[0]) == k else 0
                scores, place = block.search(item, k, floor)
                if not len(scores):
                    continue
                found = scores, block.ids[place], block.null[place]
                if before:
                    found = [np.concatenate(x) for x in zip(before, found)]
                best[number] = best_of(*found, k)
        for number, (scores, ids, null) in best.items():
            yield record_batch(
                schema,
                [
                    [number] * len(scores), scores.tolist(),
                    [None if n else i for i, n in zip(ids.tolist(), null.tolist())],
                ],
            )

    return run


def _ranked(found, k):
    """The k best rows of each item, with their rank."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS))
    first = Window.partitionBy("item", "part").orderBy(*order)
    some = (
        found.withColumn("part", group).withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k).drop("rank", "part")
    )
    last = Window.partitionBy("item").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def _slices(items, chars):
    """Frames of the items, each of about ``chars`` characters, dealt by a hash of the id."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + int(total) // chars
    part = F.pmod(F.xxhash64("item_id"), F.lit(count))
    return [items.where(part == i) for i in range(count)]


def _numbered(rows):
    """``{term: number}`` and ``[(item_id, {number: times})]`` of the items of a slice."""
    vocabulary, by_id = {}, {}
    for row in rows:
        counts = by_id.setdefault(row["item_id"], {})
        for term in terms_of((row["text"] or "").encode()):
            number = vocabulary.setdefault(term, len(vocabulary))
            counts[number] = counts.get(number, 0) + 1
    return vocabulary, list(by_id.items())


def search(docs, items, k=TOP, slice_chars=SLICE_CHARS):
    """``item_id, rank, doc_id, score``: the k best documents of every item."""
    spark = docs.sparkSession
    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    found, whole = [], None
    for part in _slices(items, slice_chars):
        vocabulary, asked = _numbered(part.collect())  # about slice_chars characters
        if not asked:
            continue
        table = postings(docs, vocabulary)
        if whole is None:
            whole = table.where("size > 0").agg(
                F.count(F.lit(1)).alias("documents"), F.sum("size").alias("terms")
            ).first()
        holding = dict(
            table.select(F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("n")).collect()  # at most the slice's terms
        )
        weights = {t: weight_of(whole["documents"], n) for t, n in holding.items()}
        rarest = {
            number: [
                (t, times * weights[t])
                for t, times in sorted(counts.items(), key=lambda x: (holding.get(x[0], 0), x[0]))
                if t in weights
            ]
            for number, (_, counts) in enumerate(asked)
        }
        best = map_arrow(
            table, _search(rarest, whole["documents"], whole["terms"] or 0, k),
            "item int, score bigint, doc_id bigint",
        )
        kind = items.schema["item_id"].dataType.simpleString()
        names = spark.createDataFrame(
            [(i, item_id) for i, (item_id, _) in enumerate(asked)], f"item int, item_id {kind}"
        )
        # as many names as the slice has items
        found.append(_ranked(best, k).join(F.broadcast(names), "item"))
    if not found:
        empty = "item_id {}, rank int, doc_id bigint, score bigint"
        return spark.createDataFrame([], empty.format(items.schema["item_id"].dataType.simpleString()))
    whole_result = found[0]
    for part in found[1:]:
        whole_result = whole_result.unionByName(part)
    return whole_result.select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n) AS terms FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
item AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id,
         sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS score
  FROM item JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM ranked WHERE place <= 10
"""
