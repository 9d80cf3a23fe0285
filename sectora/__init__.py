"""sectora — a Spark-native reporting engine for multi-tenant entity-attribute-value data.

Records of a tenant (org) belong to sections; each record carries attribute values.
The engine folds those values into one attribute map per record in a single
distributed pass, projects wide section tables and reports from it lazily, and
manages report definitions, snapshots and task figures as DataFrame jobs.
"""

__version__ = "0.1.0"
