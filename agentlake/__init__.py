"""agentlake: the data work behind LLM-agent applications as Spark DataFrame operators."""

__version__ = "0.1.0"
