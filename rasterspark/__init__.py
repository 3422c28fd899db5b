"""Satellite raster time series on Spark: normalised percentile composites, audits, catalogs, telemetry."""
