"""Manifests, headers, CSV readers and the partitioned snapshot store."""
