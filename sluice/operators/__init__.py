"""Operators: analytics over loaded tables, transfer checks, key assignment."""
