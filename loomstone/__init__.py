"""Loomstone: repository-evidence analytics expressed as Spark DataFrame plans."""
