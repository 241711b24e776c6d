"""Panel time-series analytics as Spark DataFrame operators.

Every operator is a function from DataFrame to DataFrame over a long panel
``series_id, ts, value``.  Nothing runs until the caller asks for a result;
the exceptions (model fits and iterative clustering) say so.
"""

__version__ = "0.1.0"
