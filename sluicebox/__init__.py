"""Open-data refinery on Spark: messy published files in, audited tables out."""
