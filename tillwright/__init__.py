"""Tillwright: a layered retail-sales warehouse expressed as Spark DataFrame operators."""
