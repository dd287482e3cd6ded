"""DuckDB SQL that recomputes each registered query independently.

These strings are the correctness oracle for ``__spark_entry__.queries()``:
they run in DuckDB over the same parquet tables. They are written from the
rule definitions with their own fixed values (``values.py``), not from the
Spark plans, and import nothing of the engine.
"""
