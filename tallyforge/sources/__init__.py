"""Readers that turn external files and topics into typed DataFrames."""
