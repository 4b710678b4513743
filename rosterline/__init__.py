"""Snapshot-registry analytics as PySpark DataFrame functions.

``functions``  column expressions (text, dates, grid cells, fixed code tables)
``sources``    file manifests, headers, CSV readers and the partitioned snapshot store
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole flows: value histories, provider profile, employer directory
``streaming``  incremental pick-up of new snapshot files
"""
