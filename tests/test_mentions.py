import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pulse.functions.mentions import extract_mentions, matched_terms, parse_mentions
from pulse.functions.terms import (
    BLOCKED_TERMS, CATEGORIES, DEFAULT_TERMS, MIN_TERM_LENGTH, SUBSTRING_NEEDLES, TermDictionary,
)
from tests.helpers import initial_plan


def tag(spark, titles, terms=DEFAULT_TERMS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id int, title string")
    rows = df.select("id", matched_terms(F.col("title"), terms).alias("hits")).collect()
    return [list(r["hits"]) for r in sorted(rows, key=lambda r: r["id"])]


def restated(title, terms):
    """The matching rule said literally, one containment test after the other."""
    low = title.lower()
    wide = " " + low + " "
    hits = []
    for term in terms.terms:
        if term.is_substring:
            found = any(n in low for n in term.needles)
        else:
            w = term.name
            found = any(x in wide for x in (f" {w} ", f" {w},", f" {w}.", f" {w}:", f"({w})"))
        if found:
            hits.append(term.name)
    return hits


def test_dictionary_size():
    assert sum(len(t) for t in CATEGORIES.values()) == 78
    assert len(CATEGORIES) == 10
    assert len(DEFAULT_TERMS.delimited) == 69
    assert len(DEFAULT_TERMS.substring) == 8
    assert "s3" not in DEFAULT_TERMS.names
    # all names in order; the SQL statements take them from the same place
    listed = "\n".join(f"{c}:{','.join(t)}" for c, t in CATEGORIES.items())
    digest = hashlib.sha256(listed.encode()).hexdigest()
    assert digest == "70cded00149d4127594801ce8cd6006e279bc87838e048d589871e9bc97ffbf9"


@pytest.mark.parametrize(
    "title, expected",
    [
        ("sql sql", ["sql"]),
        ("SQL.", ["sql"]),
        ("(sql)", ["sql"]),
        ("sql: x", ["sql"]),
        ("use sql", ["sql"]),
        ("use sql, now", ["sql"]),
        ("sql.parser", ["sql"]),
        ("((sql)", ["sql"]),
        ("a(sql)b", ["sql"]),
        ("sql;", []),
        ("sql!", []),
        ("sql?", []),
        ("a-sql", []),
        ("sql)", []),
        ("(sql ", []),
        (".sql", []),
        ("x\tsql", []),
        ("sql\nx", []),
        ("llms, llm", ["llm", "llms"]),
        ("javascript", []),
        ("pysparks", ["pyspark"]),
        ("torchlight", ["pytorch"]),
        ("tf2 guide", ["tensorflow"]),
        ("big query", ["bigquery"]),
        ("BigQuery", ["bigquery"]),
        ("lang chain", ["langchain"]),
        ("hugging face", ["huggingface"]),
        ("power bi", ["powerbi"]),
        ("scikit-learn", ["scikitlearn"]),
        ("sklearn", ["scikitlearn"]),
        ("scikitlearn", []),
        ("s3 pricing", []),
        ("spark sql", ["sql", "spark"]),
        ("gitlab, github. git", ["git", "github", "gitlab"]),
        ("", []),
        (None, []),
    ],
)
def test_rule(spark, title, expected):
    assert tag(spark, [title]) == [expected]


def test_categories(spark):
    df = spark.createDataFrame([("torch, pandas and sql",)], "title string")
    got = df.select(extract_mentions(F.col("title")).alias("m")).first()["m"]
    assert got == {
        "sql": "Query Languages",
        "pytorch": "Machine Learning & AI",
        "pandas": "Data Science Libraries",
    }


def test_random_titles_against_restated_rule(spark):
    rng = random.Random(7)
    words = DEFAULT_TERMS.names + [n for ns in SUBSTRING_NEEDLES.values() for n in ns]
    words += ["s3", "r", "go", "x", "xsqly", "Ünï", "日本"]
    glue = [" ", " ", " ", ",", ".", ":", ";", "(", ")", "-", "\t", "\n", "", "  ", ") (", "((", "))"]
    titles = []
    for _ in range(6000):
        parts = []
        for _ in range(rng.randint(1, 6)):
            word = rng.choice(words)
            parts.append(rng.choice(glue))
            parts.append(word.upper() if rng.random() < 0.1 else word)
        parts.append(rng.choice(glue))
        titles.append("".join(parts))
    assert tag(spark, titles) == [restated(t, DEFAULT_TERMS) for t in titles]


def test_terms_with_delimiters_of_their_own(spark):
    terms = TermDictionary.build(
        {"Web": ["node.js", "vue", "ruby on rails", "c(x)"]}, {"vue": ["vue"]}
    )
    titles = ["node.js", "use node.js, now", "xnode.js", "ruby on rails.", "vuex", "c(x) y", ""]
    assert tag(spark, titles, terms) == [restated(t, terms) for t in titles]
    assert tag(spark, ["anything"], TermDictionary.build({})) == [[]]


def test_long_text_is_read_to_its_end(spark):
    assert tag(spark, ["word " * 40000 + "sql"]) == [["sql"]]


def test_dictionary_is_validated():
    with pytest.raises(ValueError):
        TermDictionary.build({"A": ["x1"], "B": ["x1"]})
    with pytest.raises(ValueError):
        TermDictionary.build({"A": ["Xyz"]})
    for bad in ({"A": [""]}, {"A": ["x\ny"]}, {"A\t": ["xyz"]}):
        with pytest.raises(ValueError):
            TermDictionary.build(bad)
    with pytest.raises(ValueError):
        TermDictionary.build({"A": ["abc"]}, {"other": ["o"]})
    blocked = TermDictionary.build({"A": ["go", "tf", "abc"]}, {}, BLOCKED_TERMS, MIN_TERM_LENGTH)
    assert blocked.names == ["abc"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a":"x"}', {"a": "x"}),
        ('{"a": "x", "b": "y"}', {"a": "x", "b": "y"}),
        ('{"a":"x","a":"z"}', {"a": "z"}),
        ('{"a":"x","b":"y","a":"z"}', {"a": "z", "b": "y"}),
        ("{bad", {}),
        ('{"a":"x", bad', {}),
        ('{"a":"x"', {}),
        ('"text"', {}),
        ("7", {}),
        ("", {}),
        ("null", {}),
        ("[]", {}),
        ('["a"]', {}),
        (None, {}),
        ("{}", {}),
    ],
)
def test_parse(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    row = df.select(parse_mentions(F.col("c")).alias("m"), F.size(parse_mentions(F.col("c"))).alias("n")).first()
    assert row["m"] == expected
    assert row["n"] == len(expected)


def test_no_python_in_the_plan(spark, events):
    from checks.events_feed import raw_posts

    plan = initial_plan(raw_posts(events))
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
