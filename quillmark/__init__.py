"""Reconciliation of versions of long, structured documents, as Spark DataFrame functions."""
