"""tickforge: a Spark-native trade lakehouse.

Raw trade messages become typed bronze rows, cleaned and de-duplicated
silver trades, OHLCV candles (gold) and four analytical marts. Every
transformation is a ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so the same code runs in batch and in
Structured Streaming and Catalyst plans all of it.
"""

__version__ = "0.1.0"
