"""Payment-risk analytics as plain DataFrame -> DataFrame functions on PySpark."""
