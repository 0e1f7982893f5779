"""A writer of documents holds the bytes of one document once."""

import math
import tracemalloc

import pyarrow as pa

from pulse.sources import snapshots as lake


def documents(spark, lines, size):
    """What a task of the writer gives, run in this process on batches of lines."""
    taken = {}

    class Rows:
        schema = spark.range(0).selectExpr("'' AS value").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            taken["function"] = function

    lake._array_documents(Rows(), [], size)
    batches = (
        pa.RecordBatch.from_arrays([pa.array(lines[k : k + 1000])], names=["value"])
        for k in range(0, len(lines), 1000)
    )
    return taken["function"](batches)


def test_a_writer_holds_its_document_once(spark):
    lines = ['{"title":"%s %d"}' % ("x" * 300, k) for k in range(30_000)]
    text = sum(len(x) + 2 for x in lines)
    tracemalloc.start()
    for document in documents(spark, lines, size=math.inf):
        peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert document.column(0)[0].as_py() == "[\n" + ",\n".join(lines) + "\n]"
    assert peak < 2 * text


def test_documents_hold_every_line_whole(spark):
    lines = ["", "é" * 40, "b" * 30, "c" * 90, "d"]
    got = [d.column(0)[0].as_py() for d in documents(spark, lines, size=100)]
    assert got == ["[\n" + ",\n".join([*lines[:3]]) + "\n]", "[\n" + ",\n".join(lines[3:]) + "\n]"]
