"""tessera: analytics jobs written as PySpark DataFrame / SQL / ML / Streaming plans.

Every public function takes and returns DataFrames (or small driver-side
model objects whose size is bounded by model parameters, never by data).
"""

__version__ = "0.1.0"
