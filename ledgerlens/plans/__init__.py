"""Jobs composed from operators, and the registered queries that run them
over the driver's tables (see ``registry``)."""
