"""Gaugeflow: streamflow verification and calibration tables on Spark."""
