"""shopfold: multi-store order flattening, status normalisation and upserts on Spark.

Raw store orders (nested JSON, one VARIANT per document) are flattened to one
row per line item in a fixed 13-column table, statuses are normalised through a
per-site mapping, duplicates are removed and the result is merged into a
partitioned table.  Everything is expressed with DataFrame / SQL operators so
Catalyst plans it; nothing is collected to the driver.
"""

__all__ = ["session", "schema"]
