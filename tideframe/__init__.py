"""tideframe: analytics operators written as plain Spark DataFrame jobs.

Every operator is a function DataFrame -> DataFrame built from Spark SQL
expressions.  Nothing is collected on the driver, there are no Python UDFs,
and every group that reaches one task has a bound that does not depend on how
skewed the data is (see README, "Scale").
"""
