"""starkiln: a Spark-native ELT and analytics library for trip/event fact data.

Staging, star-schema marts, incremental write strategies, SCD2 snapshots and
declarative data-quality tests, all expressed as DataFrame / SQL plans.
"""

__version__ = "0.1.0"
