"""sluice: bulk data movement and row-level reshaping as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (or a reader/writer wrapper)
built from Spark's own column expressions, so it runs distributed, keeps whole-stage
codegen, and works on streaming frames wherever it is stateless.

Sub-packages:

* ``sluice.sources``   – scans: delimited text, sequence files, tables, SQL scripts, JDBC, file inventory
* ``sluice.operators`` – row processors, validation, upsert, cell reshaping, bulk documents, report
* ``sluice.functions`` – column functions: delimiters, templates, coercions, rendering
* ``sluice.sinks``     – writers: delimited text, sequence, table overwrite, JDBC, documents, checksums, noop
* ``sluice.plans``     – ``TransferJob``: sources -> union -> transforms -> fan-out to targets -> report
* ``sluice.streaming`` – the same stateless chains on ``readStream`` frames, multi-target ``foreachBatch``
"""

__version__ = "0.1.0"


def _ship_with_tasks() -> None:
    """Pickle sluice's task-side functions by value, so executors need no install.

    ``mapInPandas`` / RDD functions defined in this package are otherwise pickled by
    reference and fail on any worker where ``sluice`` is not importable.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_with_tasks()
