"""tidewatch: transaction-risk analytics written as Spark DataFrame plans."""
