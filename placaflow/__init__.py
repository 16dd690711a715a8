"""Plate-lifecycle reporting on Spark: active plates, cancellations, KPIs, backfills."""
