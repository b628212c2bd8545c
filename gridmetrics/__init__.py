"""Medallion analytics over metered time series, expressed as Spark plans.

Layers: ``sources`` (landing zone, tables), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame), ``plans`` (the jobs that write tables) and
``streaming`` (incremental pick-up of new landing files).
"""
