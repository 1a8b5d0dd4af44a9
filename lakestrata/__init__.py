"""lakestrata: a medallion (bronze / silver / gold) analytics engine on PySpark.

Every operator is a DataFrame / Spark SQL plan; nothing runs row-by-row in Python.
"""

__version__ = "0.1.0"
