"""movelake: movement-data analytics on Spark.

Landed raw payloads -> fixed-schema movement tables (flights, ships,
departures, satellites, vehicle_positions) -> de-dup, layout, retention ->
latency / freshness / throughput / rollup queries, batch and streaming.
Everything is a DataFrame transformation; nothing is collected to the driver.
"""

__version__ = "0.1.0"
