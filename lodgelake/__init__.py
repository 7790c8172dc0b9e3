"""lodgelake: rental-listing and census analytics expressed as Spark DataFrame plans.

Layers: ingest (bronze) -> cleaning (silver) -> slowly-changing history ->
star schema -> data marts -> analyses.  Every public function takes and
returns DataFrames; nothing is collected to the driver.
"""

__version__ = "0.1.0"
