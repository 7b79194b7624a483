"""Hourly retail analytics on Spark: catalog, sales and inventory slots.

A *slot* is one ``(date, hour)``. Every dataset is stored one slot per
``date=/hour=`` folder, and every operator takes and returns DataFrames.
"""

__version__ = "0.1.0"
