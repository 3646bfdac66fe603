"""Sources and sinks: typed JSON decode/encode, keyed text, declared streams, table loads, sinks."""
