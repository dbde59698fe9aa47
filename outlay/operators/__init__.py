"""``DataFrame -> DataFrame`` operators."""
