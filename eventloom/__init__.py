"""Event-announcement analytics and corpus preparation as PySpark DataFrame operators."""
