"""Loan-performance analytics as Spark DataFrame operators."""
