"""weekloom: daily-to-weekly feature stores, risk labels and profiling on Spark.

Every operator is a function from DataFrame to DataFrame that works for many
series keys at once; nothing here holds data in the driver.
"""

__version__ = "0.1.0"
