"""Marketplace-observation analytics on Spark DataFrames.

``sources`` read raw observations, Silver tables and change logs, ``operators``
turn DataFrames into DataFrames, ``sinks`` write tables that can be written
again, ``plans`` chain them and ``streaming`` runs the incremental forms.
"""
