"""matchlake: match-document analytics as Spark DataFrame jobs.

Layers
------
sources     read and write bronze documents and raw tables, table catalog,
            derivation of raw tables from the generated driver tables
operators   nested-array operators, flatten (documents -> raw tables),
            assemble (raw rows -> documents), extraction over page tables
functions   scalar Column helpers (labels, casts, dates, splits)
plans       staging models, the daily / range job, the query registry
streaming   incremental runner over a landing directory

Typical use
-----------
>>> from matchlake.sources import io
>>> from matchlake.plans import job, models
>>> job.run_day(spark, "s3://lake/bronze", "2022-02-26", "s3://lake/raw")   # W1
>>> job.run_range(spark, "s3://lake/bronze", "s3://lake/raw",
...               start="2022-01-01", end="2022-12-31")                      # W2
>>> raw = io.RawCatalog(spark, "s3://lake/raw")
>>> models.publish(raw)          # stg_* temp views, evaluated when read
>>> spark.sql("SELECT * FROM stg_maps_results")
"""

__all__ = ["schemas"]
