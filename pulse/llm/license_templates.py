"""License scans: templates with markup, matched as automata over words.

A template is the wording of a license or notice. ``<<optional>> ... <</optional>>`` may be
left out; ``<<var a-b>>`` stands for ``a`` to ``b`` words of any kind. Everything else is
mandatory and must stand there word for word, after folding case and punctuation. Each
template becomes an automaton over words; it is tried where a word stands that can open it,
and the longest accepted stretch counts. A text without a template's rare word skips it. The
templates are those of ``license_wordings``; a scan takes others as a parameter.

Base phrases are found wherever their words stand in a row; template matches are added.

Defined cases: null text counts as empty (no words, no places, score 0); matches of one
template do not overlap (leftmost, longest), those of different ones may; repeated rows give equal results each; an empty
table gives no rows; other columns are not looked at.
"""

import re

from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.license_wordings import TEMPLATES

# Phrases every scan must report, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)
_MARK = re.compile(r"<<(/?optional|var (\d+)-(\d+))>>")


def words_of(text):
    """Words of a text (bytes): runs of a-z (either case), digits and non-ASCII characters."""
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """States are places between words. ``step[s]`` maps a word to the next state; ``any[s]``
    is the state after a word of any kind; ``skip[s]`` are states reached without a word."""

    def __init__(self, wording):
        self.step, self.any, self.skip = [{}], [None], [[]]
        stack, last, at = [], 0, 0
        for mark in _MARK.finditer(wording):
            last = self._wording(last, wording[at : mark.start()])
            at = mark.end()
            if mark.group(1) == "optional":
                stack.append(last)
            elif mark.group(1) == "/optional":
                self.skip[stack.pop()].append(last)
            else:
                low, high = int(mark.group(2)), int(mark.group(3))
                starts = []
                for k in range(high):
                    if k >= low:
                        starts.append(last)
                    new = self._state()
                    self.any[last] = new
                    last = new
                for s in starts:
                    self.skip[s].append(last)
        self.final = self._wording(last, wording[at:])
        self.opening = {w for s in self._closure({0}) for w in self.step[s]}

    def _state(self):
        self.step.append({}), self.any.append(None), self.skip.append([])
        return len(self.step) - 1

    def _wording(self, last, wording):
        for word in words_of(wording.encode()):
            new = self._state()
            self.step[last][word] = new
            last = new
        return last

    def _closure(self, states):
        todo = list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words, start):
        """End of the longest accepted stretch from ``start``, or None."""
        states, end = self._closure({0}), None
        for i in range(start, len(words)):
            word, reached = words[i], set()
            for s in states:
                if word in self.step[s]:
                    reached.add(self.step[s][word])
                if self.any[s] is not None:
                    reached.add(self.any[s])
            states = self._closure(reached)
            if not states:
                break
            if self.final in states:
                end = i + 1
        return end


class Scanner:
    """Base phrases and templates over one text."""

    def __init__(self, templates=TEMPLATES):
        self.base = [
            (b" " + phrase.encode() + b" ", label, phrase.count(" ") + 1)
            for phrase, label in BASE_PHRASES.items()
        ]
        self.templates = [
            (label, rare.encode(), Automaton(wording)) for label, rare, wording in templates
        ]

    def scan(self, text):
        """Number of words, base places and template matches as (label, start, end)."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base, found = [], []
        for phrase, label, size in self.base:
            at = joined.find(phrase)
            while at >= 0:
                start = joined.count(b" ", 0, at)
                base.append((label, start, start + size))
                at = joined.find(phrase, at + 1)
        tried = [
            (label, automaton)
            for label, rare, automaton in self.templates
            if b" " + rare + b" " in joined
        ]
        if tried:
            openings = set().union(*[a.opening for _, a in tried])
            behind = [0] * len(tried)  # end of the last match of each template
            for i, word in enumerate(words):
                if word in openings:
                    for k, (label, automaton) in enumerate(tried):
                        if i >= behind[k] and word in automaton.opening:
                            end = automaton.longest(words, i)
                            if end is not None:
                                found.append((label, i, end))
                                behind[k] = end
        return len(words), base, found


_PLACES = "array<struct<label:string,start:bigint,end:bigint>>"
_NAMES = ("label", "start", "end")


def _scan(templates):
    def run(batches, schema):
        scanner = Scanner(templates)
        for batch in batches:
            scanned = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            yield record_batch(
                schema,
                [
                    batch.column(0).to_pylist(),
                    [s[0] for s in scanned],
                    *[
                        [[dict(zip(_NAMES, p)) for p in s[k]] for s in scanned]
                        for k in (1, 2)
                    ],
                ],
            )

    return run


def scan_licenses(docs, templates=TEMPLATES):
    """``doc_id, n_words, base, found``; places are counted in words, ends exclusive."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    return map_arrow(
        rows, _scan(templates), f"doc_id bigint, n_words bigint, base {_PLACES}, found {_PLACES}"
    )


def _labels(places):
    return F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ","
    )


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    every = F.concat("base", "found")
    starts = F.transform(every, lambda p: p["start"])
    base_starts = F.transform("base", lambda p: p["start"])
    covered = F.array_distinct(
        F.flatten(F.transform(every, lambda p: F.sequence(p["start"], p["end"] - 1)))
    )
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(base_starts).alias("first_word"),
        F.array_max(base_starts).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(every).alias("labels"),
        F.when(F.size(starts) > 0, F.size(covered) / F.col("n_words"))
        .otherwise(0.0)
        .cast("double")
        .alias("score"),
    )
