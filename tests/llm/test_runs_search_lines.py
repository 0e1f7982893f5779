"""Periodic runs, ranked search and line dedup against brute force, and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import line_dedup, line_quality, periodic_runs, ranked_search, scaled_sketch
from tests.llm.test_llm import LONG, ODD_TEXTS, SMALL

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# --- 11: periodic runs -------------------------------------------------------------------


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def brute_row(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_runs_of_a_table_equal_brute_force(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = periodic_runs.query(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = brute_planted(r.doc_id, SPACE.findall(texts[r.doc_id]))
        if len(words) > 2000 and (folder != SMALL or not r.n_runs):
            continue  # brute force takes the square of the length
        assert tuple(r[c] for c in COLUMNS) == brute_row(words), r.doc_id


def solved(texts):
    """Runs of each text, by the steps of the operator without Spark."""
    pieces = {}
    for i, unit, start, lead, count, ids, open_end in periodic_runs.strips(
        [np.array(t, np.int64) for t in texts]
    ):
        for q, a, b in periodic_runs.solve_strip(ids, unit, start, lead, count, open_end):
            pieces.setdefault((i, q), []).append((a, b))
    found = [{} for _ in texts]
    for (i, q), parts in sorted(pieces.items()):
        whole = []
        for a, b in sorted(parts):
            if whole and a + q <= whole[-1][1]:
                whole[-1][1] = max(b, whole[-1][1])
            else:
                whole.append([a, b])
        for a, b in whole:
            if b - a >= max(6, 4 * q):
                found[i].setdefault((a, b), q)
    return [sorted((a, b - a, q) for (a, b), q in f.items()) for f in found]


def periodic_texts(rng, count):
    for _ in range(count):
        text = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33])
            block = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(p)]
            text += (block * rng.randint(1, 12))[: rng.randint(0, 200)]
            text += [rng.randrange(60) for _ in range(rng.randint(0, 6))]
        yield text


@pytest.mark.parametrize("strip_words", [1, 16, 1 << 15])
def test_random_periods_equal_brute_force(monkeypatch, strip_words):
    monkeypatch.setattr(periodic_runs, "STRIP_WORDS", strip_words)
    rng = random.Random(strip_words)
    texts = list(periodic_texts(rng, 300)) + [[0] * n for n in range(12)]
    assert solved(texts) == [brute_runs(t) for t in texts]


def test_every_short_text_equals_brute_force():
    texts = [list(t) for n in range(13) for t in itertools.product((0, 1), repeat=n)]
    assert solved(texts) == [brute_runs(t) for t in texts]


def test_z_values():
    assert periodic_runs.z_values("aabaab", 6)[1:] == [1, 0, 3, 1, 0]
    assert periodic_runs.z_values("", 3) == [] and periodic_runs.z_values("aaaa", 2)[1] == 3


def test_runs_on_odd_tables(spark, odd, none):
    rows = periodic_runs.find_runs(odd.withColumn("runs", F.lit("clash"))).collect()
    assert len(rows) == odd.count()
    texts = {i: t or "" for i, t in enumerate(ODD_TEXTS)}
    for r in rows:
        if r.doc_id in texts and texts[r.doc_id] != LONG:
            assert [tuple(x) for x in r.runs] == brute_runs(SPACE.findall(texts[r.doc_id]))
    assert periodic_runs.find_runs(none).count() == 0 and periodic_runs.digest(periodic_runs.find_runs(none)).count() == 0
    rows = [(None, "a b " * 50), (None, "a b " * 50), (None, None), (1, "x " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic_runs.digest(periodic_runs.find_runs(df)).where("n_runs > 0").collect()
    assert sorted((r.doc_id or 0, r.start, r.length, r.period) for r in got) == [
        (0, 0, 100, 2), (0, 0, 100, 2), (1, 0, 100_000, 1),
    ]


# --- 12: ranked search -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_search(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b, {w: b.count(w) for w in set(b)}) for i, b in bags if b]
    n_docs, n_terms, out = len(bags), sum(len(b) for _, b, _ in bags), {}
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    for item, words in asked.items():
        found = []
        for i, b, tf in bags:
            score = 0
            for w in words:
                if w in tf:
                    df = sum(w in t for _, _, t in bags)
                    m = 25 + 75 * len(b) * n_docs // n_terms
                    score += ranked_search.weight_of(n_docs, df) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out[item] = [(r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return {item: rows for item, rows in out.items() if rows}


@pytest.mark.parametrize("block, chars, k", [(1 << 14, 4 << 20, 10), (3, 30, 2), (7, 100, 5)])
def test_search_equals_brute_force(spark, monkeypatch, block, chars, k):
    rng = random.Random(block)
    words = ["the", "of"] * 8 + [f"w{i}" for i in range(40)] + ["Été", "漢字", "A1"]
    text = lambda n: " ".join(rng.choices(words, k=n)) + rng.choice([".", "", "!x"])
    docs = [(i, text(rng.randint(0, 30))) for i in range(60)] + [(60, None), (61, ""), (None, "w1 the"), (None, "w1 the")]
    docs += [(100 + i, docs[5][1]) for i in range(20)] + [(7, "w3 w3 w4"), (7, "w3 w3 w4")]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(3, "w1 w1 w1 été"), (None, "w2 w3"), (50, None), (51, "unheard"), (52, "")]
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(0))
    got = {}
    for r in ranked_search.search(df, asked, k, chars).collect():
        got.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    assert {i: sorted(rows, key=lambda r: r[0]) for i, rows in got.items()} == brute_search(docs, items, k)
    assert ranked_search.search(df.limit(0), asked).count() == 0
    assert ranked_search.search(df, asked.limit(0)).count() == 0


def test_accumulators_stop_before_common_terms(monkeypatch):
    """A block in which only rare terms create accumulators still ranks exactly."""
    rng = np.random.default_rng(0)
    terms_in = [[0, 9] if i < 12 else [9] for i in range(5000)]
    times = [[5, 1] if i < 12 else [1] for i in range(5000)]
    sizes = rng.integers(1, 50, 5000).tolist()
    block = ranked_search.Block(list(range(5000)), sizes, terms_in, times, 5000, sum(sizes))
    item = [(0, ranked_search.weight_of(5000, 12)), (9, ranked_search.weight_of(5000, 5000))]
    scores, place = block.search(item, 10)
    assert set(place.tolist()) <= set(range(12)) and len(place) >= 10
    whole = np.zeros(5000, np.int64)
    for t, w in item:
        a, b = block.lists[t]
        whole[block.place[a:b]] += w * block.worth[a:b]
    assert scores.tolist() == whole[place].tolist() and scores.min() >= np.sort(whole)[-10]


def test_long_sizes_do_not_overflow():
    big = ranked_search.impacts([3], [10**9], 10**11, 10**13)
    m = 25 + 75 * 10**9 * 10**11 // 10**13
    assert big.tolist() == [3 * 10**9 // (3000 + 8 * m)]


# --- 13: lines ---------------------------------------------------------------------------


def brute_lines(rows, least=2):
    key = lambda x: re.sub("[A-Z]", lambda m: m.group().lower(), x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: float("inf") if i is None else i
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < 10 or len(holders[key(x)]) < least or order(i) == min(holders[key(x)])
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 3])
def test_lines_equal_brute_force(spark, least):
    rng = random.Random(least)
    lines = ["", " ", "short", "Ten chars!", "  ten CHARS!\t", "é" * 9, "é" * 10, "É" * 10, "x" * 9, "a longer line here\r", "A longer line here", "own"]
    text = lambda: "\n".join(rng.choices(lines + [f"rare line {rng.randrange(90)}"], k=rng.randint(1, 9)))
    rows = [(i, text()) for i in range(60)] + [(None, text()), (None, text()), (5, text()), (5, text()), (70, None), (71, "")]
    rows += [(72, rows[3][1])] * 3 + [(73, LONG + "\n" + LONG)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("row", "own", "same", "places", "n_lines", "line")})
    out = line_dedup.dedup_lines(df, min_docs=least)
    got = sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()), key=str)
    assert got == brute_lines(rows, least)
    assert out.select("row.*").columns == df.columns and out.where("n_dropped > 0").count() > 0
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_of_odd_tables(spark, odd):
    got = {r.row.doc_id: r for r in line_dedup.dedup_lines(odd).collect()}
    assert got[8].n_dropped == 0 and got[9].kept_text == "" and got[0].n_lines == 1
    assert got[101].n_dropped == 0  # rows of one document do not count as two


# --- filters on results ------------------------------------------------------------------

QUALITY_FILTERS = [
    "n_words > 100", "word_chars > 100", "n_symbols = 0", "n_dup_lines > 0", "n_repeat_words > 10",
    "base_failed", "kept",
]
SKETCH_FILTERS = [
    "n_chars > 100", "edited_sha256 > '8'", "fingerprint LIKE '%8'", "edited_fingerprint LIKE '%8'",
    "near_edited < 0.9", "near_next < 0.1",
]


@pytest.mark.parametrize(
    "module, conditions", [(line_quality, QUALITY_FILTERS), (scaled_sketch, SKETCH_FILTERS)]
)
def test_filters_on_any_result_column(spark, module, conditions):
    """A filter stays above the steps that cut a text up, and finds what it should."""
    whole = module.query(spark, SMALL)
    rows = spark.createDataFrame(whole.collect(), whole.schema).cache()
    for condition in [*conditions, " AND ".join(conditions)]:
        found = whole.where(condition)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.split("\n") if re.match(r"[\s:+-]*Filter", line)]
        assert not any(re.search("split|sequence", line) for line in filters), condition
        assert found.count() == rows.where(condition).count(), condition
