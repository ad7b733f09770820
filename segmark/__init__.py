"""segmark: customer segmentation on Spark.

Raw order rows -> staged orders -> one row per person -> rule segments and
K-Means segments -> dimension / fact / wide mart tables, plus data-quality checks.
Every operator is a DataFrame -> DataFrame function on the public Spark API.
"""

__version__ = "0.1.0"
