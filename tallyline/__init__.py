"""Reconcile orders, payments, merchants and settlements on Spark."""
