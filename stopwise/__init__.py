"""Reliable public-transport journey planning as Spark DataFrame operators."""
