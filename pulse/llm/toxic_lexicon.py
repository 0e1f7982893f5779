"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding: lower case, look-alike letters of other scripts and digit substitutions become the
Latin letters they stand for, everything else that is no letter becomes a space. Entries
are whole words or word beginnings. An entry's weight is the lower bound of its log odds
between toxic and clean labelled rows, so rare entries count for little; the fixed seed
words have a set weight where the labels do not know them better. Of several entries that
match at one word the heaviest counts, and none if an exception phrase covers the word.

The score is a logistic function of the heaviest match, the sum of matches over the square
root of the number of words, and a constant. Folds are ``crc32(doc_id as text) mod 5``:
fold 0 is held out and never used, folds 2 to 4 give the weights, fold 1 the function.

Bounds: the weights and the function are learned from about ``SAMPLE`` labelled rows, chosen
by hash over the whole table; at most ``ENTRIES`` entries are kept and sent to the tasks.

Defined cases: null text counts as empty and gets the constant's score; without usable
labels the seed words and fixed coefficients decide; labels that are null or not 0/1 are
left out; of several labels of one document the highest counts; repeated rows score alike;
an empty table gives no rows; other columns are not looked at.
"""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.arrow import bound_batches, map_arrow, record_batch
from pulse.llm.columns import free_name

SAMPLE = 20_000
ENTRIES = 20_000
BEGINNINGS = (4, 5, 6)  # letters
LEAST_WEIGHT = 1.5
SEED_WEIGHT = 4.0

# General insults, and phrases in which they are harmless.
SEED_WORDS = (
    "clown disgusting dumb idiot imbecile loser moron pathetic scum stupid trash worthless"
).split()
EXCEPTIONS = (
    "clown fish", "clown nose", "class clown", "pond scum", "soap scum", "trash bin",
    "trash can", "trash collection",
)

# Letters that look alike, and digits written for letters.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "α": "a", "β": "b", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a",
}
_WORD = re.compile(r"[^\W_]+")
_FOLD = str.maketrans(LOOK_ALIKE)


def fold(text):
    """Folded words of a text, each between single spaces."""
    return " " + " ".join(_WORD.findall((text or "").lower().translate(_FOLD))) + " "


def entries_of(folded):
    """All possible entries of a folded text: words (`` word ``) and beginnings (`` wor``)."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:k]}" for k in BEGINNINGS if len(word) >= k)
    return found


class Lexicon:
    """Weights of entries, compiled to one automaton with the exception phrases."""

    def __init__(self, weights, exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            folded = fold(phrase)
            self.automaton.add_word(folded, (len(folded), None))
        for entry, weight in weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def features(self, text):
        """The heaviest match, and the sum of matches over the root of the word count."""
        folded = fold(text)
        best, covered = {}, []
        if not self.empty:
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    covered.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        for start, end in covered:
            for at in [s for s in best if start <= s < end]:
                del best[at]
        if not best:
            return 0.0, 0.0
        return max(best.values()), sum(best.values()) / math.sqrt(max(1, folded.count(" ") - 1))


def _count_entries(batches, schema):
    """Partial counts of entries by class, passed on whenever they fill up."""
    toxic, clean = Counter(), Counter()

    def counts():
        names = list(toxic.keys() | clean.keys())
        return record_batch(
            schema, [names, [toxic[n] for n in names], [clean[n] for n in names]]
        )

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if label else clean).update(entries_of(fold(text)))
        if len(toxic) + len(clean) > 300_000:
            yield counts()
            toxic.clear(), clean.clear()
    yield counts()


def labelled_sample(docs, labels, sample=SAMPLE):
    """``text, toxic, fold`` of about ``sample`` labelled rows outside the held-out fold."""
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    usable = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("fold", fold_of)
        .where("fold != 0")
    )
    rows = usable.count()
    share = min(1.0, sample / max(1, rows))
    chosen = usable.where((F.abs(F.xxhash64(F.lit(1), "doc_id") % 1_000_000)) < int(share * 1_000_000))
    # about ``sample`` narrow rows
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def learn_weights(sample, entries=ENTRIES):
    """Entry weights from the rows of folds 2 to 4."""
    rows = sample.where("fold > 1")
    totals = rows.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))
    ).first()
    n_toxic, n_clean = int(totals[0]), int(totals[1] - totals[0])
    weights = {f" {w}": SEED_WEIGHT for w in SEED_WORDS}
    if not n_toxic or not n_clean:
        return weights
    counts = (
        map_arrow(rows.select("text", "toxic"), _count_entries, "entry string, t bigint, c bigint")
        .groupBy("entry")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where("t > 1")
    )
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    doubt = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    kept = (
        counts.withColumn("weight", F.round(odds - 1.5 * doubt, 6))
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("weight"), "entry")
        .limit(entries)
    )
    for entry, _, _, weight in kept.collect():
        weights[entry] = max(weight, weights.get(entry, 0.0))
    return weights


def _features(weights):
    """Column function: the two features of a text, as a struct."""
    import pandas as pd

    @F.pandas_udf("heaviest double, total double")
    def run(texts: pd.Series) -> pd.DataFrame:
        lexicon = _lexicon(weights)
        found = [lexicon.features(t) for t in texts]
        return pd.DataFrame(found, columns=["heaviest", "total"])

    return run(F.col("text").cast("string"))


_BUILT = {}


def _lexicon(weights):
    """The automaton of these weights, built once in a worker process."""
    key = hash(frozenset(weights.items()))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Lexicon(weights)
    return _BUILT[key]


DEFAULT = (-6.0, 2.0, 0.5)  # constant, heaviest match, sum of matches


def fit_function(rows, rounds=50):
    """Coefficients of the logistic function, from (heaviest, sum, label); ridge towards
    the defaults, Newton steps."""
    prior = np.array(DEFAULT)
    if not rows:
        return DEFAULT
    data = np.array(rows, float)
    x = np.column_stack([np.ones(len(data)), data[:, :2]])
    y = data[:, 2]
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - 0.5 * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(docs, labels, sample=SAMPLE, entries=ENTRIES):
    """Weights and coefficients. What is gathered is bounded by ``entries`` and ``sample``."""
    rows = labelled_sample(docs, labels, sample)
    weights = learn_weights(rows, entries)
    bound_batches(docs.sparkSession)
    check = rows.where("fold = 1").select("toxic", _features(weights).alias("f"))
    return weights, fit_function(
        [tuple(r) for r in check.select("f.heaviest", "f.total", "toxic").collect()]
    )


def with_score(docs, model, name="score"):
    """``docs`` plus its score, row by row."""
    weights, (constant, heaviest, total) = model
    bound_batches(docs.sparkSession)
    features = free_name(docs, "features")
    scored = docs.withColumn(features, _features(weights))
    z = constant + heaviest * F.col(features)["heaviest"] + total * F.col(features)["total"]
    return scored.withColumn(name, 1 / (1 + F.exp(-z))).drop(features)


def keep_clean(docs, labels):
    """The rows of ``docs`` that score below one half, with their columns."""
    score = free_name(docs, "toxic_score")
    scored = with_score(docs, learn(docs, labels), score)
    return scored.where(F.col(score) < 0.5).drop(score)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = with_score(docs, learn(docs, labels))
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return scored.select(
        "doc_id",
        (crc % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
