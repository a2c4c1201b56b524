"""Payment records on Spark: raw CSV to query-ready tables, batch only."""
