"""DataFrame operators: pure ``DataFrame -> DataFrame`` functions without I/O of their own."""
