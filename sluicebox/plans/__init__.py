"""Whole jobs: landed files to raw tables, raw tables to published marts."""
