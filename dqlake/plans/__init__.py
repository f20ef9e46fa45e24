"""Whole jobs: gate, lake, star schema, marts, drift, lineage, replay."""
