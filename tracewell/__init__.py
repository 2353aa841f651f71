"""Agent-trace analytics and safe export as Spark DataFrame operators."""
