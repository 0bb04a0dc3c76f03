"""Scans, sinks, the shared folder and the invoice-line view over the sample tables."""
