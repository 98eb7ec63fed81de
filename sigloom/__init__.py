"""Sensor-signal analytics as Spark jobs: ordered signals in, segment statistics, scores and messages out."""
