"""Restricted-party list data engine on Spark: readers, normalisers, gates, versioning, matching, marts, monitoring."""
