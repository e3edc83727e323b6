"""careweave: support-conversation analytics as lazy Spark DataFrame operators."""
