"""eventlake: a PySpark medallion pipeline for public code-hosting event archives.

Layers (each a plain DataFrame -> DataFrame function, no UDFs):

* ``sources``    raw JSON dumps -> Bronze, driver-table adapters, table I/O
* ``operators``  Silver normalisation and dedup, Gold marts, validation,
                 quality suites, churn features/model, physical layout
* ``functions``  reusable column expressions
* ``plans``      composite jobs (Bronze -> Silver -> Gold -> checks -> model)
* ``streaming``  the Structured Streaming form of landing

The caller owns the ``SparkSession``; :func:`eventlake.session.configure`
applies the settings the pipeline relies on.
"""

__version__ = "0.1.0"
