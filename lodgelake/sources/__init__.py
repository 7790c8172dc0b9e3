"""Sources and sinks: the driver tables mapped onto the listing/census model,
CSV month files, keyed insert-ignore appends, full refreshes and the ledger of
loaded files."""
