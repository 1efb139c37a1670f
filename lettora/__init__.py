"""Letting-income analytics by Dutch postal code, as plain Spark DataFrame functions.

Layout:

* ``params``     typed parameters (economics, grid, skew limits, column names)
* ``functions``  Column -> Column: zipcodes, numbers, GeoJSON text, geometry, money
* ``operators``  DataFrame -> DataFrame building blocks: spatial join, skew join, rank, explode, ...
* ``sources``    file and table readers      * ``sinks``  table writer with metrics
* ``plans``      bronze, silver, gold, quality and the thin jobs that read, call and write
"""
