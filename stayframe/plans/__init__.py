"""Registered queries: each family module exposes ``QUERIES`` (name ->
callable(spark, sf_dir) -> DataFrame) and ``ORACLE`` (name -> DuckDB SQL)."""
