"""Supply and quality reports over a data-supply chain, as lazy Spark plans.

``functions``  column expressions (no UDFs)
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers, writers and table schemas
``plans``      the reports, each a function from named tables to one DataFrame
"""
