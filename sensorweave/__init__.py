"""sensorweave: wearable-sensor recording harmonisation as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
transformation meant for ``df.transform(...)``; nothing on a data path
collects to the driver or runs a row-at-a-time Python UDF.
"""

__version__ = "0.1.0"
