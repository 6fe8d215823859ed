"""Whole jobs composed from the operators: audits, unified roster, statistics layers."""
