"""larkspur: DataFrame operators for behaviour logs, text, ratings and vector series.

Every operator is a plain function from DataFrame(s) and parameters to a
DataFrame.  Nothing in the package starts a session; planning and execution
are Spark's.
"""
