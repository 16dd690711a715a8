"""The reports: bases, KPIs, rankings, ad-hoc listings and snapshot backfills.

Every function takes a dict of source tables (logical name -> DataFrame) or frames
built from it, and returns a lazy DataFrame; only sinks act.
"""
