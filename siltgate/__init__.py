"""Data-quality lakehouse jobs on Spark: raw files, a declarative gate, a star schema, KPIs."""
