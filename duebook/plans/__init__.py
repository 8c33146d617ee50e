"""The loan tables and jobs, composed from the operators."""
