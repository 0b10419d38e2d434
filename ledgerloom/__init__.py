"""ledgerloom: governed reconciliation of many publishers' tables as Spark DataFrame jobs."""
