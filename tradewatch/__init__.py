"""tradewatch: trade-surveillance outlier tests as Spark DataFrame plans.

Three tests -- tenor exposure, same-day trading, new highs in gross volume --
feed one break table. See README.md for the operator list.
"""

__version__ = "0.1.0"
