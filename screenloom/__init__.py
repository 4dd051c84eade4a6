"""Spark jobs for optical pooled-screen tables: DataFrame functions keyed by well, tile and cell."""
