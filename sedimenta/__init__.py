"""Layered lakehouse loads (landing -> bronze -> silver -> gold) as Spark jobs.

Everything here is DataFrame algebra over built-in Spark functions. The caller owns
the session: nothing in this package sets a session configuration.
"""
