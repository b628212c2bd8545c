"""The library applied to the driver's test tables: stand-ins, envelopes, queries, SQL."""
