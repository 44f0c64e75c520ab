"""eventcraft: device event-log features, labelled sets, scoring and evaluation on Spark.

Every operator takes a DataFrame plus column names and returns a DataFrame.
The heavy lifting is DataFrame/SQL work that Catalyst plans; Python only
drives loops over folds and trials (a handful of iterations, never rows).
"""

__version__ = "0.1.0"
