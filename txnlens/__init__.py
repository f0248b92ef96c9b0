"""txnlens: transaction-risk analytics as Spark DataFrame operators."""
