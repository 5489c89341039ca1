"""Batch data migration and reporting on Spark DataFrames.

Sources (CSV, documents, delimited lines, JDBC) -> cleaning, deterministic
dedupe, group-mean imputation -> change set against a target -> overwrite or
update sinks; plus lookup / extreme / best-group reports on the results.
"""

__version__ = "0.1.0"
