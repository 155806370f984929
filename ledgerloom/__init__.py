"""ledgerloom: report-table analytics expressed as Spark DataFrame plans."""
