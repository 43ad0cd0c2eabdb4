"""Bindings of test tables, session settings and the layer pipelines."""
