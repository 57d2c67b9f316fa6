"""The jobs: dimension sync, facts, windowed metrics, reports."""
