"""shoal: a shop's real-time warehouse on PySpark.

Operators are DataFrame functions (``shoal.operators``) usable in batch and in
Structured Streaming; ``shoal.streaming`` holds the keyed-state processors and
streaming jobs, ``shoal.plans`` the registered queries and batch jobs.
"""

__version__ = "0.1.0"
