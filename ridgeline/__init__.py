"""ridgeline: Spark-native preparation, profiling and modelling of review-style tables.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst prunes columns, pushes filters to the scan and picks
join strategies.  Sub-packages:

* ``sources``   - JSON / Parquet readers and writers, landing -> cleaned zone, fixtures
* ``functions`` - column expressions (targets, buckets, safe division, hash folds)
* ``operators`` - cleaning, profiling, joins, histograms, ordered running sums, metrics
* ``plans``     - composed plans: feature table, model training, reports
* ``streaming`` - the row-local cleaning policy as an incremental file-stream job
"""

__version__ = "0.1.0"
