"""Readers, writers, table configuration and catalog scans."""
