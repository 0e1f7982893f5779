"""Column expressions the native operators share."""

from pyspark.sql import functions as F

# Words are runs of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"


def text_or_empty(column="text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text):
    """All words of a text, in order."""
    return F.array_remove(F.split(F.translate(text, SPACES[1:], "     "), " ", -1), "")


def shingle_hashes(words, n):
    """Hash of every window of ``n`` words; of the whole sequence if it is shorter."""
    size = F.size(words)
    long_enough = F.transform(
        F.sequence(F.lit(0), size - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]),
    )
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    none = F.array().cast("array<bigint>")
    return F.when(size >= n, long_enough).when(size > 0, whole).otherwise(none)


def row_key(*columns):
    """Two hashes that name the content of a row; never null."""
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(7), *reversed(columns)).alias("b")
    )


def free_name(df, name):
    """A column name that ``df`` does not use, whatever case names are compared in."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def held(df, columns):
    """``df`` plus computed columns that no later filter is pushed into.

    A filter on a computed column would be moved below the steps that compute it and build
    their arrays anew, inside a lambda once per element. A generator of one row stops it.
    """
    names = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*names, F.inline(F.array(row)))
