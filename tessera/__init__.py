"""tessera: Spark-native data preparation, text-corpus, evaluation and privacy analytics.

Every public operator is a plain function over ``pyspark.sql.DataFrame`` objects (or a
``Column`` builder).  The subpackages are:

* ``tessera.sources``   scans and sinks (CSV, text, binary files, JSON requests, sharded writes)
* ``tessera.operators`` relational operators: filters, joins, aggregates, windows, ordering,
  set operations, evaluation metrics, text-corpus jobs and privacy-cost tables
* ``tessera.functions`` column-level functions: strings, JSON, HTML, arrays, maps, maths, UDFs
* ``tessera.plans``     composed jobs (listing report, corpus preparation, ML stages) and the
  query catalogue wired into ``__spark_entry__.py``
* ``tessera.streaming`` Structured Streaming forms of the batch operators
"""

__version__ = "0.1.0"
