"""Consumer-credit analytics as plain Spark DataFrame jobs.

Every operator is a function from DataFrame to DataFrame.  Nothing here keeps
state, runs Python per row, or depends on the size of the data fitting anywhere
but in the executors.
"""

__version__ = "0.1.0"
