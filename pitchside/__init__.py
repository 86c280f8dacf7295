"""pitchside — a Spark-native results-analytics engine.

Raw results and a climate series are cleaned, joined, modelled as a star
schema and served as named Spark SQL queries, views, constraint checks and
data-quality profiles.  Everything is a lazy DataFrame / Spark SQL plan.
"""

__version__ = "0.1.0"
