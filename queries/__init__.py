"""Registered queries: transport tables derived from the given ones, Spark jobs and check SQL."""
