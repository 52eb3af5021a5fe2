"""Inputs: explicit schemas, driver-table bindings and readers for every layer."""
