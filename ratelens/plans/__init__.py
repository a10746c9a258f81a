"""Query plans: the rate-shop run and the queries on the driver tables."""
