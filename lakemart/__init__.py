"""lakemart: layered (raw -> staging -> mart) commerce analytics on PySpark.

``functions`` hold column expressions, ``operators`` DataFrame transformations, ``sources`` readers,
sinks and the layered table catalog, ``plans`` the staging tables, marts and refresh, and
"""
