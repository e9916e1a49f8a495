"""meterlake: electricity-meter readings as Spark DataFrame operators.

Sources parse raw text, JSON messages or Parquet into readings; operators
clean, label and aggregate them; sinks land them as partitioned Parquet,
through batch writes or Structured Streaming, using the same functions.
"""

from meterlake.schema import METER, Meter

__all__ = ["METER", "Meter"]
