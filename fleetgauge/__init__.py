"""Device-telemetry analytics as plain DataFrame operators."""
