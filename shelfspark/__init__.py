"""shelfspark: recommendation-ready tables from customer, product and
interaction feeds, written as PySpark DataFrame functions.

Layers (each a pure ``DataFrame -> DataFrame`` function, ``as_of`` explicit):

* ``sources``    CSV batch/stream readers, table readers, sinks, fixtures
* ``functions``  column expressions (bands, weights, decay) and generic
                 DataFrame helpers (latest-by, top-n, top-k, histogram)
* ``operators``  cleaning, dimensions, gold aggregates, scoring,
                 recommendations, candidates, features, exploration, ALS
* ``streaming``  incremental ingest and incremental silver
* ``plans``      the medallion DAG runner and the registered queries
"""

__version__ = "0.1.0"
