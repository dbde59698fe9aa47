"""Ad-spend analytics as Spark DataFrame operators."""
