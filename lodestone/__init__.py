"""Record consolidation on Spark: one golden record per person from overlapping sources."""
