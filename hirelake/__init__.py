"""Job-postings lake on Spark: pages and raw files -> staging -> bronze -> silver -> gold."""
