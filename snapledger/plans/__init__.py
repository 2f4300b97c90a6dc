"""The bike-share configuration: layer builds, batch runs and monitoring."""
