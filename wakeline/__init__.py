"""wakeline: analytics on ship position reports, written as plain Spark DataFrame plans."""
