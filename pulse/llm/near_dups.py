"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find grouping.

1. One pass over the texts gives each row its number of shingles, a digest of its word
   sequence, and the keys of its bands. Rows with one word sequence become a class with
   one representative (partial minimum, so a huge group of copies sends one row per task).
2. In every band the rows with one key are a bucket. Each member is paired with the member
   that meets most others over all its bands, which in a group of near copies is the text
   they were made from; the pairs are confirmed and joined into components.
3. Buckets that still hold several components compare the members outside the largest one
   with the members of other components, by signature and then by their shingle hashes, in
   the join itself: only likely links become rows, and these are confirmed too. Two members
   are compared once, in the first bucket both are in, not in every one. After that
   every pair of a bucket is confirmed, refused, or inside one component. A group of near
   copies costs its size; members of a group that are below the asked similarity to most
   others are compared with the whole bucket, in slices, but make no rows.
4. Before texts are read, a pair must agree in enough positions of the signature (two bits
   each); the bound lies five standard deviations below the asked similarity, so it loses
   about 1 link in 3 million at exactly that similarity. Texts of up to 768 shingles are
   compared by all their hashes, which loses none; longer ones by those below a power of two
   that leaves at most 768, with a bound of five deviations again.
   Pairs that pass are confirmed on the full sets of shingles, from the texts.

With 50 bands of 6 positions a link at similarity 0.8 shares no band in 1 of 4 million
cases, at 0.85 in 1 of 10^10. Shingles of the band pass are hashed, so a pass may only add
candidates; sizes and confirmations are exact.

Defined cases: null or empty texts have no shingles, link with nothing, and are their own
component; texts shorter than a shingle are one shingle; a row without ``doc_id`` gets the
component of rows with the same words, else null; ``doc_id`` should name one text (of several
texts under one id, each is compared as whichever of them is read first); an empty table
gives no rows; other columns are not looked at.
"""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.columns import free_name
from pulse.llm.components import smallest_reachable
from pulse.session import shared_folder

BANDS, ROWS = 50, 6
POSITIONS = BANDS * ROWS
COMPARED = 288  # positions compared before texts are read, 32 to a long
DEVIATIONS = 5
SAMPLED = 768  # shingle hashes of a text that buckets compare, at most
SLICE = 1_000_000  # comparisons of a bucket that are left to one slice
FEW_IDS = 1_000_000  # ids up to which the texts' rows are chosen by a broadcast

_M64 = (1 << 64) - 1


def _mix(x):
    """A 64-bit finaliser, on arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text):
    """Words of a text (bytes), A-Z in lower case."""
    return (text or b"").lower().split()


def shingles(words, n):
    """The set of ``n``-word shingles; the whole sequence if there are fewer words."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(n)]))


def word_hashes(words, known):
    """64-bit hashes of words as an array; ``known`` keeps those of words seen before."""
    found = list(map(known.get, words))
    if None in found:
        for i, h in enumerate(found):
            if h is None:
                w = words[i]
                digest = hashlib.blake2b(w, digest_size=8).digest()
                found[i] = known[w] = int.from_bytes(digest, "little")
    return np.array(found, np.uint64)


def shingle_hashes(words, n, known):
    """Distinct hashes of a text's shingles."""
    h = word_hashes(words, known)
    if len(h) >= n:
        with np.errstate(over="ignore"):
            out = h[: len(h) - n + 1].copy()
            for k in range(1, n):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    elif len(h):
        with np.errstate(over="ignore"):
            out = h[:1].copy()
            for k in range(1, len(h)):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + 1])
    else:
        return h
    return np.unique(out)


def super_minhash(elements, owner, documents, m):
    """SuperMinHash of many sets at once: an array (documents, m) of positions' values.

    ``elements`` are 64-bit hashes, ``owner`` the set each belongs to. In step j every
    element of a set places the value j + r at the j-th entry of its own random permutation
    of the positions, r in [0, 1). A set is finished when no later step can lower any of its
    positions, that is when all hold values of steps so far. Values are kept as 64-bit
    integers, the step in the top bits, so they compare as the fractions would.
    """
    empty = np.uint64(_M64)
    signature = np.full(documents * m, empty, np.uint64)
    swaps = np.empty((0, len(elements)), np.int32)
    with np.errstate(over="ignore"):
        for j in range(m):
            draw = _mix(elements + np.uint64((j * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & _M64))
            # upper half: the swap partner in j..m-1; lower half: r
            k = j + (((draw >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int32)
            # entry k of the permutation after the swaps of the earlier steps
            place = k.copy()
            for i in range(j - 1, -1, -1):
                place = np.where(place == swaps[i], i, place)
            value = (np.uint64(j) << np.uint64(48)) | ((draw & np.uint64(0xFFFFFFFF)) << np.uint64(16))
            np.minimum.at(signature, owner * m + place, value)
            open_sets = (signature.reshape(documents, m) == empty).any(axis=1)
            going = open_sets[owner]
            if not going.any():
                break
            elements, owner = elements[going], owner[going]
            swaps = np.concatenate([swaps, k[None]])[:, going]
    return signature.reshape(documents, m)


def band_keys(signature, bands=BANDS, rows=ROWS):
    """One 64-bit key per band; the number of the band is part of it."""
    with np.errstate(over="ignore"):
        parts = signature.reshape(len(signature), bands, rows)
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for r in range(rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _sign(n):
    """Arrow function: doc_id, text -> doc_id, n_shingles, same, bits, keys."""

    def run(batches, schema):
        known = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [[], [], [], [], []]
            hashes, group = [], []

            def flush():
                if not group:
                    return
                owner = np.repeat(np.arange(len(group)), [len(h) for h in hashes])
                signature = super_minhash(np.concatenate(hashes), owner, len(group), POSITIONS)
                keys = band_keys(signature).view(np.int64)
                with np.errstate(over="ignore"):
                    two = (_mix(signature[:, :COMPARED]) & np.uint64(3)).astype(np.uint8)
                bits = np.packbits(np.stack([two >> 1, two & 1], axis=2).reshape(len(group), -1), axis=1)
                bits = bits.view(np.int64)
                for row, (i, size, same) in enumerate(group):
                    for column, value in zip(
                        out, (i, size, same, bits[row].tolist(), keys[row].tolist())
                    ):
                        column.append(value)
                hashes.clear(), group.clear()

            for i, text in zip(ids, batch.column(1).to_pylist()):
                words = words_of(text)
                if len(known) > 400_000:
                    known.clear()
                if words:
                    same = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                    group.append((i, len(shingles(words, n)), same))
                    hashes.append(shingle_hashes(words, n, known))
                    if sum(map(len, hashes)) > 200_000:
                        flush()
                else:
                    for column, value in zip(out, (i, 0, None, None, [])):
                        column.append(value)
            flush()
            yield record_batch(schema, out)

    return run


def sign(docs, n):
    """Signed rows, written down once: the texts are read for this and for confirmations."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    signed = map_arrow(
        rows,
        _sign(n),
        "doc_id bigint, n_shingles bigint, same binary, bits array<bigint>, keys array<bigint>",
    )
    folder = shared_folder(docs.sparkSession, "signed")
    signed.write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def may_link(x, y, percent):
    """Condition on two member structs: sizes and signatures allow a link."""
    agree = 0.25 + 0.75 * percent / 100
    least = agree - DEVIATIONS * (agree * (1 - agree) / COMPARED) ** 0.5
    apart = F.lit(0)
    for k in range(COMPARED // 32):
        differ = F.col(f"{x}.bits")[k].bitwiseXOR(F.col(f"{y}.bits")[k])
        either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1))
        apart += F.bit_count(either.bitwiseAND(F.lit(0x5555555555555555)))
    return (
        (100 * F.col(f"{x}.n_shingles") >= percent * F.col(f"{y}.n_shingles"))
        & (100 * F.col(f"{y}.n_shingles") >= percent * F.col(f"{x}.n_shingles"))
        & (apart <= int((1 - least) * COMPARED))
    )


def sample_of(hashes):
    """Level, sample and counts of a text's sorted shingle hashes.

    Level k leaves the hashes below 2 ** (64 - k). The sample is that of the first level of
    at most ``SAMPLED`` hashes; the counts are those of this level and the next ones, as long
    as any hash is left.
    """
    level, kept = 0, len(hashes)
    while kept > SAMPLED:
        level += 1
        kept = int(np.searchsorted(hashes, np.uint64(1 << (64 - level))))
    counts, k = [kept], level
    while counts[-1] and k < 63:
        k += 1
        counts.append(int(np.searchsorted(hashes, np.uint64(1 << (64 - k)))))
    return level, hashes[:kept], counts


def _sample(n):
    """Arrow function: doc_id, text -> doc_id and the parts of ``sample_of``."""

    def run(batches, schema):
        known = {}
        for batch in batches:
            out = [[], [], [], []]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(known) > 400_000:
                    known.clear()
                level, hashes, counts = sample_of(shingle_hashes(words_of(text), n, known))
                for column, value in zip(out, (i, level, hashes.view(np.int64).tolist(), counts)):
                    column.append(value)
            yield record_batch(schema, out)

    return run


def shingle_samples(docs, ids, n):
    """``id, sample`` of the texts named: all hashes of a text's shingles, or the smallest."""
    sampled = map_arrow(
        _texts(docs, ids), _sample(n), "id bigint, level int, hashes array<bigint>, counts array<int>"
    )
    return _written(
        sampled.select("id", F.struct("level", "hashes", "counts").alias("sample")), "samples"
    )


def samples_link(x, y, percent):
    """Condition on two member structs: their shingle hashes allow a link.

    Below the bound of the higher level both samples are whole, and all shared hashes lie
    there. Where both samples hold all hashes, this leaves out no link: a shingle hidden by a
    collision is counted as shared. Longer texts are compared on the part below that bound.
    """
    p = percent / 100
    level = F.greatest(f"{x}.sample.level", f"{y}.sample.level")
    hashes = F.col(f"{x}.sample.hashes"), F.col(f"{y}.sample.hashes")
    # the costly part: each condition is solved for it, so that it is evaluated once
    shared = F.size(F.array_intersect(*hashes))
    most = shared + F.col(f"{x}.n_shingles") - F.size(hashes[0])
    exact = (100 + percent) * most >= percent * (F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles"))
    # shared >= p * union - DEVIATIONS * sqrt(p * (1 - p) * union), with union = seen - shared
    seen = sum(
        F.coalesce(F.get(f"{z}.sample.counts", level - F.col(f"{z}.sample.level")), F.lit(0))
        for z in (x, y)
    )
    spread = DEVIATIONS * (p * (1 - p)) ** 0.5
    root = (spread + F.sqrt(spread**2 + 4 * (1 + p) * seen)) / (2 * (1 + p))
    near = seen - shared <= F.pow(root, 2)
    return F.when(level == 0, exact).otherwise(near)


def first_meeting(x, y, key):
    """Condition on two member structs: no smaller key is shared by the two.

    Members without a list of their keys meet in every bucket they share.
    """
    shared = F.array_min(F.array_intersect(f"{x}.keys", f"{y}.keys"))
    return F.coalesce(shared == F.col(key), F.lit(True))


def _confirm(n, percent):
    """Arrow function: pairs with texts -> pairs linked on their full shingle sets."""

    def run(batches, schema):
        last, last_set = None, None
        for batch in batches:
            out = [[], []]
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for a, b, text_a, text_b in zip(*columns):
                if a != last:
                    last, last_set = a, shingles(words_of(text_a), n)
                other = shingles(words_of(text_b), n)
                shared = len(last_set & other)
                if 100 * shared >= percent * (len(last_set) + len(other) - shared):
                    out[0].append(a), out[1].append(b)
            yield record_batch(schema, out)

    return run


def _texts(docs, ids):
    """``rep, t`` of the rows whose ids are in ``ids`` (one column, repeats allowed)."""
    ids = _written(ids.distinct(), "ids")
    if ids.count() <= FEW_IDS:  # otherwise both sides are shuffled
        ids = F.broadcast(ids)
    return (
        docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("binary").alias("t"))
        .join(ids, "rep", "left_semi")
        .dropDuplicates(["rep"])
    )


def confirmed(pairs, docs, n, percent):
    """The pairs ``a, b`` that are links."""
    spark = docs.sparkSession
    pairs = _written(pairs, "pairs")
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")))
    with_texts = (
        pairs.join(texts.toDF("b", "text_b"), "b")
        .join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return _written(map_arrow(with_texts, _confirm(n, percent), "a bigint, b bigint"), "links")


def _written(df, purpose):
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _written_compiled(df, purpose):
    """As ``_written``, for long conditions: the JVM leaves methods above 8000 bytes uncompiled,
    so a stage that would become one such method is to run operator by operator."""
    conf, limit = df.sparkSession.conf, "spark.sql.codegen.hugeMethodLimit"
    before = conf.get(limit)
    conf.set(limit, 8000)
    try:
        return _written(df, purpose)
    finally:
        conf.set(limit, before)


def components(docs, n=5, percent=80):
    """``doc_id, n_shingles, component_id`` for every row."""
    signed = sign(docs, n)
    # One row per word sequence: its smallest id stands for it.
    smallest = F.min(
        F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "n_shingles", "bits", "keys")
    )
    classes = _written(
        signed.where("same IS NOT NULL")
        .groupBy("same")
        .agg(smallest.alias("r"))
        .select(
            "same", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n_shingles"),
            F.col("r.bits").alias("bits"), F.col("r.keys").alias("keys"),
        ),
        "classes",
    )
    # Buckets with more than one member. The keys are shuffled once, for both uses.
    members = (
        classes.where("rep IS NOT NULL").select("rep", F.explode("keys").alias("key")).repartition("key")
    )
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = _written(members.join(shared, "key"), "buckets")
    meets = members.groupBy("rep").agg(
        F.sum("size").alias("meets"), F.count(F.lit(1)).alias("buckets")
    )
    about = meets.join(classes.dropDuplicates(["rep"]), "rep").select(
        "rep", F.struct("meets", "rep", "n_shingles", "bits", "buckets").alias("x")
    )
    members = _written(members.join(about, "rep").select("key", "x"), "buckets")
    first = members.groupBy("key").agg(F.max("x").alias("y"))
    pairs = (
        members.join(first, "key")
        .where("y.rep != x.rep")
        .where(may_link("x", "y", percent))
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )
    links = confirmed(pairs, docs, n, percent)
    groups = smallest_reachable(links)

    # Buckets with members of several components.
    placed = _written(
        members.withColumn("rep", F.col("x.rep"))
        .join(groups.toDF("rep", "c"), "rep", "left")
        .select("key", "x", F.coalesce("c", "rep").alias("c")),
        "placed",
    )
    counts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size"))
    mixed = (
        counts.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.max(F.struct("size", "c")).alias("big"),
            F.sum("size").alias("all"),
        )
        .where("parts > 1")
        .select(
            "key",
            F.col("big.c").alias("largest"),
            F.ceil((F.col("all") - F.col("big.size")) * F.col("all") / SLICE).alias("slices"),
        )
    )
    placed = _written(placed.join(mixed, "key"), "mixed")
    samples = shingle_samples(docs, placed.select("x.rep"), n)
    # Two members are compared in the first bucket they share. Only an id of several texts
    # has more buckets than bands; it gets no list and is compared in every one.
    own = (
        placed.where(F.col("x.buckets") <= BANDS)
        .groupBy(F.col("x.rep").alias("id"))
        .agg(F.collect_set("key").alias("keys"))
    )
    placed = placed.join(
        samples.join(own, "id", "left"), F.col("x.rep") == F.col("id")
    ).withColumn("x", F.struct("x.rep", "x.n_shingles", "x.bits", "sample", "keys"))
    # A large bucket is dealt out: its left side in slices, its right side to every slice.
    left = placed.where("c != largest").select(
        "key", F.pmod(F.xxhash64("x.rep"), "slices").alias("slice"), "x", "c"
    )
    right = placed.select(
        "key",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"),
        F.col("x").alias("y"),
        F.col("c").alias("d"),
        (F.col("c") == F.col("largest")).alias("in_largest"),
    )
    across = (
        left.join(right, ["key", "slice"])
        .where("c != d")
        .where("in_largest OR x.rep < y.rep")  # two of the left side meet once
        .where(
            may_link("x", "y", percent)
            & first_meeting("x", "y", "key")
            & samples_link("x", "y", percent)
        )
        .select(
            F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")
        )
        .distinct()
    )
    across = _written_compiled(across, "across")
    more = confirmed(across.join(pairs, ["a", "b"], "left_anti"), docs, n, percent)
    groups = smallest_reachable(links.unionByName(more))

    named = (
        classes.select("same", "rep")
        .join(groups.toDF("rep", "component"), "rep", "left")
        .select("same", F.coalesce("component", "rep").alias("component"))
    )
    return signed.join(named, "same", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs, n=5, percent=80):
    """The rows of ``docs`` that stand for their component, with their columns.

    Rows without ``doc_id`` and rows that share the id of a kept one stay.
    """
    others = components(docs, n, percent).where("doc_id != component_id")
    gone = free_name(docs, "gone")
    others = _written(others.select(F.col("doc_id").alias(gone)).distinct(), "gone")
    if others.count() <= FEW_IDS:  # otherwise both sides are shuffled
        others = F.broadcast(others)
    return docs.join(others, F.col("doc_id") == F.col(gone), "left_anti")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return components(docs, n=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1]
                               ELSE words[p] || ' ' || words[p + 1] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), 2))) AS p
        FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  WHERE 100 * na.n >= 80 * nb.n AND 100 * nb.n >= 80 * na.n
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
