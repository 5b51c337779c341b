"""strata: layered data-preparation operators on PySpark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small set of
DataFrames) built from Spark SQL expressions, so Catalyst plans, prunes and
pushes down across operator boundaries.  Sub-packages:

* ``sources``   - raw file readers, ingestion guards, schema drift, tables
* ``functions`` - column expressions (cleansing, bands, masks, keys, money)
* ``operators`` - dedup, null ratio, imputation, upsert, history, star, quality
* ``streaming`` - incremental (high-water-mark) loading and file-stream ingest
* ``plans``     - layer runs (bronze / silver / gold) and the query catalogue
"""

__version__ = "0.1.0"
