"""Capture, selection, decoding and document scans."""
