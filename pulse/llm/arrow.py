"""Arrow hand-over between Spark and the operators that run Python in tasks."""

import pyarrow as pa

# Rows and bytes of one batch. Texts may be long, so both are bounded: a worker holds one
# batch and its result at a time.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def bound_batches(spark):
    """Set the batch limits on the session. They are read when a plan is made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def arrow_schema(ddl):
    """The Arrow schema of a flat DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def record_batch(schema, columns):
    """A record batch from one list per field."""
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def map_arrow(df, function, ddl):
    """``df.mapInArrow`` with bounded batches; ``function(batches, schema)`` yields batches."""
    bound_batches(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches):
        yield from function(batches, schema)

    return df.mapInArrow(run, ddl)
