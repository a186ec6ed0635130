"""tidemark: snapshot ELT on Spark DataFrames.

Landed files become typed raw tables, raw tables become de-duplicated staging
tables, staging tables become marts, and marts become metrics.  Every step is a
``DataFrame -> DataFrame`` function; clocks, periods and paths are arguments.
"""

__version__ = "0.1.0"
