"""factlake: a bitemporal evidence lake for market-data messages, written as Spark plans.

Facts, decisions and availability markers are three append-only tables.  Every operator is a
function ``DataFrame -> DataFrame``; nothing is collected except bounded check results.
"""

__version__ = "0.1.0"
