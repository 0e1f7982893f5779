"""The technology term dictionary.

A dictionary is an ordered list of terms, each with one category and one way of
matching:

* ``delimited`` terms stand between delimiters (see ``functions.mentions``);
* ``substring`` terms match wherever one of their needles occurs.
"""

from dataclasses import dataclass

# Categories and their terms, both in order.
CATEGORIES = {
    "Programming Languages": ["python", "scala", "java", "golang", "rust"],
    "Query Languages": ["sql", "nosql", "graphql", "sparksql", "hiveql"],
    "Data Engineering": [
        "airflow", "dbt", "prefect", "dagster", "luigi", "kafka", "spark", "pyspark",
        "flink", "nifi",
    ],
    "Cloud Platforms": [
        "aws", "gcp", "azure", "snowflake", "databricks", "redshift", "bigquery", "synapse",
    ],
    "Databases": [
        "postgresql", "mysql", "mongodb", "cassandra", "redis", "duckdb", "sqlite",
        "elasticsearch",
    ],
    "Visualization & BI": [
        "powerbi", "tableau", "looker", "metabase", "grafana", "superset", "streamlit",
        "plotly",
    ],
    "Machine Learning & AI": [
        "tensorflow", "pytorch", "scikitlearn", "keras", "xgboost", "lightgbm",
        "huggingface", "langchain", "openai", "llm", "llms", "chatgpt", "claude",
    ],
    "Data Science Libraries": [
        "pandas", "numpy", "scipy", "matplotlib", "seaborn", "shap", "mlflow", "optuna",
        "polars",
    ],
    "Storage & Formats": ["parquet", "iceberg", "delta", "hudi", "s3", "hdfs"],
    "DevOps & Infra": ["docker", "kubernetes", "terraform", "git", "github", "gitlab"],
}

# The terms found by substring, with their needles.
SUBSTRING_NEEDLES = {
    "scikitlearn": ["scikit-learn", "sklearn"],
    "powerbi": ["power bi", "powerbi"],
    "huggingface": ["hugging face", "huggingface"],
    "langchain": ["langchain", "lang chain"],
    "pytorch": ["pytorch", "torch"],
    "tensorflow": ["tensorflow", "tf2"],
    "pyspark": ["pyspark"],
    "bigquery": ["bigquery", "big query"],
}

# Terms that are listed but never matched, and the shortest live term.
BLOCKED_TERMS = ["r", "s", "go", "tf"]
MIN_TERM_LENGTH = 3


@dataclass(frozen=True)
class Term:
    name: str
    category: str
    needles: tuple = ()

    @property
    def is_substring(self):
        return bool(self.needles)


@dataclass(frozen=True)
class TermDictionary:
    """Live terms in match order."""

    terms: tuple

    @classmethod
    def build(cls, categories, needles=None, blocked=(), min_length=1):
        needles = needles or {}
        live, seen = [], set()
        for category, names in categories.items():
            for name in names:
                if name != name.lower() or not name:
                    raise ValueError(f"term {name!r} is blank or not lower case")
                if "\n" in name + category or "\t" in name + category:
                    raise ValueError(f"term {name!r} or its category has a line break or tab")
                if name in seen:
                    raise ValueError(f"term {name!r} is listed twice")
                seen.add(name)
                if name not in blocked and len(name) >= min_length:
                    live.append(Term(name, category, tuple(needles.get(name, ()))))
        unknown = set(needles) - seen
        if unknown:
            raise ValueError(f"needles for unknown terms: {sorted(unknown)}")
        return cls(tuple(live))

    @property
    def names(self):
        return [t.name for t in self.terms]

    @property
    def delimited(self):
        return [t for t in self.terms if not t.is_substring]

    @property
    def substring(self):
        return [t for t in self.terms if t.is_substring]


DEFAULT_TERMS = TermDictionary.build(
    CATEGORIES, SUBSTRING_NEEDLES, BLOCKED_TERMS, MIN_TERM_LENGTH
)
