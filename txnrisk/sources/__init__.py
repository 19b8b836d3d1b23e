"""Readers: the queue, layer tables, parquet trees and the test fixture."""
