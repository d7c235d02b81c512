"""Page analytics on Spark: landed page/post/insight JSON -> staging -> ODS -> star schema.

Layout
------
- ``functions``  Column -> Column expressions (text cleaning, post type, JSON repair).
- ``operators``  DataFrame -> DataFrame building blocks (first-wins insert, partial upsert,
                 JSON object explode, surrogate keys, quality checks).
- ``sources``    readers: test-table adapters, page lists, landed API responses, layer tables.
- ``plans``      the jobs, one per target table (ODS, cleaning, DW) and the whole pipeline.
- ``streaming``  incremental ingest of landed responses (file source, available-now trigger).
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
