"""Trade-tick analytics on Spark: candles, indicators, advice, panels and reports."""
