"""Readers: raw CSV, columnar tables, the driver-table adapter, the state dimension."""
