"""Inputs: envelope scans, the fixture adapter over ``events``, the scorecard history."""
