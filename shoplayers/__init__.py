"""Layered shop-behaviour warehouse and review analytics on Spark DataFrames."""
