"""Tables in and out: typed loads, log tables, service configs, test-table bindings."""
