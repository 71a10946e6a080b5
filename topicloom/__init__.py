"""topicloom: scoring documents against a topic taxonomy, on Spark."""
